"""Forecast models.

A native model is column expressions over the history array: its state at an origin, and forecasts from a
state. It runs in the JVM. Any other model is a Python function of one training series, run on Arrow batches inside the tasks. A ``Batched`` model is one
of many equally long series: a matrix with a row per series.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# training values, steps ahead -> that many forecasts
PythonModel = Callable[[np.ndarray, int], np.ndarray]


class Batched(NamedTuple):
    """A Python model of a matrix (series x points) and steps ahead, giving (series x steps)."""

    fit: Callable[[np.ndarray, int], np.ndarray]


class Fit(NamedTuple):
    """Forecasts of one series, or why there are none."""

    values: np.ndarray | None
    error: str | None


def fit_one(model: PythonModel, train: np.ndarray, steps: int) -> Fit:
    """A model may raise anything; it then has a message and no forecast for this series."""
    try:
        out = np.asarray(model(train, steps), float)
        if out.shape != (steps,):
            raise ValueError(f"{steps} forecasts asked, shape {out.shape} given")
    except Exception as error:
        return Fit(None, f"{type(error).__name__}: {error}")
    return Fit(out, None)


def fit_all(model: PythonModel | Batched, trains: list[np.ndarray], steps: int) -> list[Fit]:
    """The fit of every series, in order. Empty series go to the model as any other.

    A batched model gets all series of one length at a time. If it fails on them it is called again
    for each alone, so only the series at fault have an error.
    """
    if not isinstance(model, Batched):
        return [fit_one(model, t, steps) for t in trains]
    by_length = defaultdict(list)
    for place, train in enumerate(trains):
        by_length[len(train)].append(place)
    out: list[Fit] = [Fit(None, None)] * len(trains)
    for places in by_length.values():
        try:
            rows = np.asarray(model.fit(np.stack([trains[p] for p in places]), steps), float)
            if rows.shape != (len(places), steps):
                raise ValueError(f"shape {rows.shape} given")
            fits = [Fit(row, None) for row in rows]
        except Exception:
            alone = lambda train, n: np.asarray(model.fit(train[None, :], n), float)[0]
            fits = [fit_one(alone, trains[p], steps) for p in places]
        for place, fit in zip(places, fits):
            out[place] = fit
    return out

YEAR = 12


class Indexed(NamedTuple):
    """A native model whose state at an origin is read from the array by index."""

    # values, number of training points -> state
    read: Callable[[Column, Column], Column]
    # state, steps ahead -> forecast
    ahead: Callable[[Column, int], Column]


class Running(NamedTuple):
    """A native model whose state grows point by point.

    One pass over the array gives the state at every origin, so points are not folded again for each.
    """

    # first value -> state
    begin: Callable[[Column], Column]
    # state, next value -> state
    after: Callable[[Column, Column], Column]
    # state, steps ahead -> forecast
    ahead: Callable[[Column, int], Column]


NativeModel = Indexed | Running


def states(model: NativeModel, values: Column, first: Column, last: Column) -> Column:
    """The model's state at each origin from ``first`` to ``last`` (training lengths, at least 1)."""
    if isinstance(model, Indexed):
        return F.transform(F.sequence(first, last), lambda n: model.read(values, n))
    head = F.aggregate(F.slice(values, F.lit(2), first - 1), model.begin(_at(values, F.lit(1))), model.after)
    return F.aggregate(
        F.slice(values, first + 1, last - first),
        F.array(head),
        lambda kept, x: F.array_append(kept, model.after(F.element_at(kept, -1), x)),
    )


def _at(values: Column, index: Column) -> Column:
    """Value at a 1-based index, NULL where the series does not reach."""
    return F.when((index >= 1) & (index <= F.size(values)), F.get(values, index - 1))


#: Last training value.
naive = Indexed(_at, lambda state, step: state)

#: Value of the same month in the last training year.
seasonal_naive = Indexed(
    lambda values, n: F.array(*[_at(values, n - YEAR + k) for k in range(1, YEAR + 1)]),
    lambda state, step: F.get(state, F.lit((step - 1) % YEAR)),
)


def moving_average(points: int) -> Indexed:
    """Mean of the last ``points`` training values (of all, if there are fewer)."""

    def read(values: Column, n: Column) -> Column:
        size = F.least(n, F.lit(points))
        window = F.slice(values, F.greatest(n - points + 1, F.lit(1)), size)
        added = F.aggregate(window, F.lit(0.0), lambda acc, x: acc + x)
        return F.when(n >= 1, F.try_divide(added, size.cast("double")))

    return Indexed(read, lambda state, step: state)


#: Last training value, carried on along the line from the first.
drift = Indexed(
    lambda values, n: F.struct(
        _at(values, F.lit(1)).alias("first"), _at(values, n).alias("last"), n.alias("n")
    ),
    lambda state, step: state["last"]
    + F.try_divide((state["last"] - state["first"]) * step, (state["n"] - 1).cast("double")),
)


def smoothing(alpha: float) -> Running:
    """Level of simple exponential smoothing, started at the first value."""
    return Running(
        lambda x: x,
        lambda level, x: x * alpha + level * (1 - alpha),
        lambda level, step: level,
    )


def trend_smoothing(alpha: float, beta: float) -> Running:
    """Double exponential smoothing: a level and a trend, started at the first value without a trend."""

    def after(state: Column, x: Column) -> Column:
        level = x * alpha + (state["level"] + state["trend"]) * (1 - alpha)
        trend = (level - state["level"]) * beta + state["trend"] * (1 - beta)
        return F.struct(level.alias("level"), trend.alias("trend"))

    return Running(
        lambda x: F.struct(x.alias("level"), F.lit(0.0).alias("trend")),
        after,
        lambda state, step: state["level"] + state["trend"] * step,
    )


NATIVE_MODELS: dict[str, NativeModel] = {
    "naive": naive,
    "seasonal_naive": seasonal_naive,
    "moving_avg": moving_average(3),
    "drift": drift,
    "smoothing": smoothing(0.5),
}

#: Models of a running state.
RUNNING_MODELS: dict[str, NativeModel] = {
    "smoothing": smoothing(0.5),
    "slow_smoothing": smoothing(0.125),
    "trend_smoothing": trend_smoothing(0.5, 0.25),
}


def python_naive(train: np.ndarray, horizon: int) -> np.ndarray:
    return np.full(horizon, train[-1])


def python_seasonal_naive(train: np.ndarray, horizon: int) -> np.ndarray:
    if len(train) < YEAR:
        return np.full(horizon, np.nan)
    return np.resize(train[-YEAR:], horizon)


def python_moving_average(points: int) -> PythonModel:
    def model(train: np.ndarray, horizon: int) -> np.ndarray:
        return np.full(horizon, train[-points:].mean())

    return model


def python_drift(train: np.ndarray, horizon: int) -> np.ndarray:
    if len(train) < 2:
        return np.full(horizon, np.nan)
    steps = np.arange(1, horizon + 1)
    return train[-1] + (train[-1] - train[0]) * steps / (len(train) - 1)


def python_smoothing(alpha: float) -> PythonModel:
    def model(train: np.ndarray, horizon: int) -> np.ndarray:
        level = train[0]
        for x in train[1:]:
            level = x * alpha + level * (1 - alpha)
        return np.full(horizon, level)

    return model


def python_ratio(train: np.ndarray, horizon: int) -> np.ndarray:
    """Last value, grown once more as it grew from the one before."""
    if len(train) < 2 or train[-2] == 0:
        raise ValueError("no growth from zero")
    return np.full(horizon, train[-1] * train[-1] / train[-2])


def batch_moving_average(points: int) -> Batched:
    def fit(trains: np.ndarray, horizon: int) -> np.ndarray:
        return np.repeat(trains[:, -points:].mean(axis=1)[:, None], horizon, axis=1)

    return Batched(fit)


def _year_share(trains: np.ndarray, horizon: int) -> np.ndarray:
    """Last value, scaled by its share of the last year's mean."""
    total, last = trains[:, -YEAR:].sum(axis=1), trains[:, -1]
    if (total == 0).any():
        raise ValueError("a year without units")
    return np.repeat((last * last * YEAR / total)[:, None], horizon, axis=1)


#: Models that fail on some items.
PARTIAL_MODELS: dict[str, PythonModel | Batched] = {
    "ratio": python_ratio,
    "batch_avg": batch_moving_average(3),
    "year_share": Batched(_year_share),
}

PYTHON_MODELS: dict[str, PythonModel] = {
    "naive": python_naive,
    "seasonal_naive": python_seasonal_naive,
    "moving_avg": python_moving_average(3),
    "drift": python_drift,
    "smoothing": python_smoothing(0.5),
}

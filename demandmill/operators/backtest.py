"""Forecasts from full series, and from rolling origins over the last months.

With a series of length l, a lead time lt and m test months, the training prefixes have lengths
l - lt - m .. l - lt - 1 and each gives the forecast lt + 1 steps ahead, so the targets are exactly
the last m points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandmill.functions.dates import add_months, header_of, month_label
from demandmill.functions.rules import floor_zero, half_even
from demandmill.operators.models import Batched, Fit, NativeModel, PythonModel, fit_all, states
from demandmill.operators.series import SERIES, dates_of, values_of
from demandmill.shipping import ship_package

EXPORT_LABEL = "Custom Stat"


class ModelFailed(Exception):
    """A model raised for an item."""


def _fits(
    pdf: pd.DataFrame, name: str, model: PythonModel | Batched, steps: int, errors: bool
) -> list[Fit]:
    fits = fit_all(model, [np.asarray(t) for t in pdf["Train"]], steps)
    if not errors:
        for sku, fit in zip(pdf["SKU"], fits):
            if fit.error:
                raise ModelFailed(f"{name} on item {sku}: {fit.error}")
    return fits


def _span(months: int, lead_time: int) -> tuple[Column, Column]:
    """First and last training length of an item."""
    length = F.size(SERIES)
    return F.greatest(length - lead_time - months, F.lit(1)), length - lead_time - 1


def origins(series: DataFrame, months: int, lead_time: int) -> DataFrame:
    """One row per item and test month: training length and target index.

    Origins whose training prefix would be empty are left out.
    """
    first, last = _span(months, lead_time)
    return series.select(
        "SKU", SERIES, F.explode(F.when(last >= 1, F.sequence(first, last))).alias("Origin")
    )


def test_set_forecasts(
    series: DataFrame, models: dict[str, NativeModel], months: int = 3, lead_time: int = 3
) -> DataFrame:
    """``SKU, Model, Origin, Target_Month, Month, Forecast`` for native models.

    A model's states at all origins come from one pass over the item's array; only states and target
    months are copied per origin, and after the series are built there is no further shuffle.
    """
    step = lead_time + 1
    first, last = _span(months, lead_time)
    at_origins = F.arrays_zip(
        F.sequence(first, last).alias("n"),
        F.slice(dates_of(), first + step, last - first + 1).alias("target"),
        *[states(m, values_of(), first, last).alias(f"m{i}") for i, m in enumerate(models.values())],
    )
    # The condition is part of the array: a filter might be evaluated after it.
    kept = series.select("SKU", F.inline(F.when(last >= 1, at_origins)))
    forecasts = F.array(
        *[
            F.struct(
                F.lit(name).alias("Model"),
                floor_zero(half_even(model.ahead(F.col(f"m{i}"), step))).alias("Forecast"),
            )
            for i, (name, model) in enumerate(models.items())
        ]
    )
    return kept.select(
        "SKU", F.col("n").alias("Origin"), F.col("target").alias("Target_Month"), F.inline(forecasts)
    ).select(
        "SKU", "Model", "Origin", "Target_Month", month_label("Target_Month").alias("Month"), "Forecast"
    )


def test_set_forecasts_python(
    series: DataFrame,
    models: dict[str, PythonModel | Batched],
    months: int = 3,
    lead_time: int = 3,
    partitions: int | None = None,
    errors: bool = False,
) -> DataFrame:
    """The same table for Python models.

    With ``errors`` a model that raises for some rows gives them no forecast and its message in a column
    ``Error``; without, it ends the job. Batched models get the rows of an Arrow batch by length.

    Each (item, origin) row carries its own training prefix, so the work spreads over rows and not
    only over items. ``partitions`` sets the number of tasks where fitting, not data size, decides.
    """
    ship_package(series.sparkSession)
    step = lead_time + 1
    n = F.col("Origin")
    rows = origins(series, months, lead_time).select(
        "SKU", "Origin",
        F.get(dates_of(), n + step - 1).alias("Target_Month"),
        F.slice(values_of(), F.lit(1), n).alias("Train"),
    )
    if partitions:
        rows = rows.repartition(partitions, "SKU", "Origin")

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, model in models.items():
                out = pdf[["SKU", "Origin", "Target_Month"]].copy()
                out["Model"] = name
                fits = _fits(pdf, name, model, step, errors)
                out["Raw"] = [np.nan if f.error else f.values[step - 1] for f in fits]
                out["Error"] = [f.error for f in fits]
                yield out

    fitted = rows.mapInPandas(
        fit, "SKU string, Origin int, Target_Month date, Model string, Raw double, Error string"
    )
    return fitted.select(
        "SKU", "Model", "Origin", "Target_Month", month_label("Target_Month").alias("Month"),
        _rounded("Raw").alias("Forecast"), *["Error"] * errors,
    )


def _rounded(name: str) -> Column:
    return floor_zero(half_even(F.nanvl(F.col(name), F.lit(None).cast("double"))))


def model_forecasts(
    series: DataFrame,
    models: dict[str, PythonModel | Batched],
    horizon: int,
    partitions: int | None = None,
    errors: bool = False,
) -> DataFrame:
    """``SKU, Model, Horizon, Target_Month, Forecast`` for Python models fitted on full series.

    One row per item goes in, so batches of items are fitted where they already are; no grouping
    shuffle is needed. With ``errors`` an item for which a model raises has one row, without step,
    month and forecast, and the message in a column ``Error``; without, it ends the job.
    """
    ship_package(series.sparkSession)
    rows = series.select(
        "SKU", values_of().alias("Train"), F.element_at(dates_of(), -1).alias("Last_Month")
    )
    if partitions:
        rows = rows.repartition(partitions, "SKU")

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, model in models.items():
                fits = _fits(pdf, name, model, horizon, errors)
                out = pdf[["SKU", "Last_Month"]].copy()
                out["Model"] = name
                out["Raw"] = [f.values for f in fits]
                out["Error"] = [f.error for f in fits]
                yield out

    fitted = rows.mapInPandas(
        fit, "SKU string, Last_Month date, Model string, Raw array<double>, Error string"
    )
    return fitted.select(
        "SKU", "Model", "Last_Month", "Error", F.posexplode_outer("Raw").alias("__pos", "__raw")
    ).select(
        "SKU", "Model",
        (F.col("__pos") + 1).alias("Horizon"),
        F.add_months("Last_Month", F.col("__pos") + 1).alias("Target_Month"),
        F.nanvl(F.col("__raw"), F.lit(None).cast("double")).alias("Forecast"),
        *["Error"] * errors,
    )


def model_forecasts_native(
    series: DataFrame, models: dict[str, NativeModel], horizon: int
) -> DataFrame:
    """The same table for native models, without a shuffle.

    A model's state at the end of the series is made once; every step ahead starts from it.
    """
    n = F.size(SERIES)
    ends = series.select(
        "SKU",
        F.get(dates_of(), n - 1).alias("__last"),
        *[F.when(n >= 1, F.get(states(m, values_of(), n, n), F.lit(0))).alias(f"__m{i}")
          for i, m in enumerate(models.values())],
    )
    forecasts = F.array(
        *[
            F.struct(
                F.lit(name).alias("Model"),
                F.lit(step).alias("Horizon"),
                F.nanvl(model.ahead(F.col(f"__m{i}"), step), F.lit(None).cast("double")).alias("Forecast"),
            )
            for i, (name, model) in enumerate(models.items())
            for step in range(1, horizon + 1)
        ]
    )
    return ends.select("SKU", "__last", F.inline(forecasts)).select(
        "SKU", "Model", "Horizon",
        F.add_months("__last", F.col("Horizon")).alias("Target_Month"), "Forecast",
    )


def forecast_export(
    forecasts: DataFrame, model: str, last_history_month, horizon: int
) -> DataFrame:
    """Export sheet of one model: a row per item, a whole-number column per month."""
    heads = [add_months(last_history_month, h) for h in range(1, horizon + 1)]
    value = floor_zero(F.col("Forecast"))
    wide = (
        forecasts.where(F.col("Model") == model)
        .groupBy(F.col("SKU").alias("Item Number"))
        .pivot("Target_Month", [d for d in heads])
        .agg(half_even(F.first(value)).cast("int"))
    )
    return wide.select(
        "Item Number",
        F.lit(EXPORT_LABEL).alias("Series / Time"),
        *[F.col(f"`{d.isoformat()}`").alias(header_of(d)) for d in heads],
    )

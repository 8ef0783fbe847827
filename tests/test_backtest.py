import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandmill.operators import backtest, models, scoring, series

JAN = dt.date(2019, 1, 1)


def wide(spark, rows, months=12, skip=()):
    heads = [f"{m}/1/2019" for m in range(1, months + 1) if m not in skip]
    schema = "Item string, x string, " + ", ".join(f"`{h}` double" for h in heads)
    return spark.createDataFrame([(k, "", *v) for k, v in rows], schema)


def test_series_is_ordered_complete_and_filled(spark):
    df = wide(spark, [("A", [1.0, None, 3.0]), ("B", [5.0, 6.0, 7.0]), ("B", [1.0, 1.0, 1.0])], 4, {3})
    got = {r.SKU: [(p.Date.month, p.History) for p in r.Nested_History]
           for r in series.history_series(df).collect()}
    assert got == {"A": [(1, 1), (2, 0), (3, 0), (4, 3)], "B": [(1, 6), (2, 7), (3, 0), (4, 8)]}


def test_series_from_columns_and_from_rows_agree(spark):
    df = wide(spark, [("A", [1.0, None, 3.0]), ("B", [5.0, 6.0, 7.0])], 4, {3})
    long = series.history_long(df)
    assert long.count() == 6 and long.where("History is null").count() == 0
    nested = series.nest_history(series.complete_calendar(long))
    assert sorted(nested.collect()) == sorted(series.history_series(df).collect())


def test_origins_and_targets(spark):
    """Length 12, lead time 3, 3 months: prefixes of 6, 7, 8 points, targets 10, 11, 12."""
    df = series.history_series(wide(spark, [("A", [float(i) for i in range(1, 13)])]))
    got = backtest.test_set_forecasts(df, {"naive": models.naive}).orderBy("Origin").collect()
    assert [(r.Origin, r.Target_Month.month, r.Month, r.Forecast) for r in got] == [
        (6, 10, "Oct_2019", 6), (7, 11, "Nov_2019", 7), (8, 12, "Dec_2019", 8),
    ]


def test_short_series(spark):
    df = series.history_series(wide(spark, [("A", [1.0] * 5)], 5))
    got = backtest.test_set_forecasts(df, models.NATIVE_MODELS).collect()
    assert {(r.Model, r.Origin, r.Forecast) for r in got} == {
        ("naive", 1, 1), ("moving_avg", 1, 1), ("seasonal_naive", 1, None), ("drift", 1, None),
        ("smoothing", 1, 1),
    }
    tiny = series.history_series(wide(spark, [("A", [1.0] * 4)], 4))
    assert backtest.test_set_forecasts(tiny, models.NATIVE_MODELS).count() == 0


def test_drift_and_smoothing(spark):
    df = series.history_series(wide(spark, [("A", [2.0, 4.0, 6.0, 8.0, 10.0, 13.0] + [0.0] * 6)]))
    two = {k: models.NATIVE_MODELS[k] for k in ("drift", "smoothing")}
    got = {r.Model: r.Forecast for r in backtest.test_set_forecasts(df, two, months=1, lead_time=5)
           .collect()}
    # six points, six steps: 13 + 11 * 6 / 5; levels 2, 3, 4.5, 6.25, 8.125, 10.5625
    assert got == {"drift": 26, "smoothing": 11}


def test_running_models_at_every_origin(spark):
    """States of one pass equal those of each prefix alone, for rising, falling and single points."""
    def by_prefix(ys, alpha, beta, steps):
        level, trend = ys[0], 0.0
        for y in ys[1:]:
            new = alpha * y + (1 - alpha) * (level + trend)
            level, trend = new, beta * (new - level) + (1 - beta) * trend
        return max(round(level + steps * trend), 0)

    rows = {"A": [float(i * i) for i in range(12)], "B": [100.0 - 9 * i for i in range(12)], "C": [0.0] * 12}
    df = series.history_series(wide(spark, list(rows.items())))
    got = {(r.SKU, r.Model, r.Origin): r.Forecast
           for r in backtest.test_set_forecasts(df, models.RUNNING_MODELS, 30, 2).collect()}
    rules = {"smoothing": (0.5, 0.0), "slow_smoothing": (0.125, 0.0), "trend_smoothing": (0.5, 0.25)}
    assert got == {(k, m, n): by_prefix(ys[:n], *rule, 3)
                   for k, ys in rows.items() for m, rule in rules.items() for n in range(1, 10)}
    full = {(r.SKU, r.Model, r.Horizon): r.Forecast
            for r in backtest.model_forecasts_native(df, models.RUNNING_MODELS, 2).collect()}
    assert len(full) == 18 and full["B", "smoothing", 1] == full["B", "smoothing", 2]
    assert full["A", "trend_smoothing", 2] > full["A", "trend_smoothing", 1] > 121


def test_native_models_of_no_points(spark):
    none = spark.createDataFrame([("A", [])], "SKU string, Nested_History array<struct<Date date, History double>>")
    assert backtest.test_set_forecasts(none, models.NATIVE_MODELS | models.RUNNING_MODELS).count() == 0
    got = backtest.model_forecasts_native(none, models.NATIVE_MODELS | models.RUNNING_MODELS, 2)
    assert {(r.Forecast, r.Target_Month) for r in got.collect()} == {(None, None)}


def test_rounded_and_not_negative(spark):
    df = series.history_series(wide(spark, [("A", [-5.0] * 6 + [0.5, 1.5] + [9.0] * 4)]))
    got = backtest.test_set_forecasts(df, {"naive": models.naive}).orderBy("Origin").collect()
    assert [r.Forecast for r in got] == [0, 0, 2]


def test_native_equals_python(spark):
    rng = np.random.default_rng(5)
    heads = [f"{m}/1/{y}" for y in (2018, 2019) for m in range(1, 13)]
    schema = "Item string, x string, " + ", ".join(f"`{h}` double" for h in heads)
    rows = [(f"S{i}", "", *map(float, rng.integers(0, 90, 24))) for i in range(30)]
    df = series.history_series(spark.createDataFrame(rows, schema))
    native = backtest.test_set_forecasts(df, models.NATIVE_MODELS, 4, 2)
    python = backtest.test_set_forecasts_python(df, models.PYTHON_MODELS, 4, 2, partitions=4)
    assert sorted(map(tuple, native.collect())) == sorted(map(tuple, python.collect()))
    assert native.count() == 30 * 5 * 4


def test_any_python_model(spark):
    """A model sees its training prefix only, and returns as many steps as asked."""
    seen = lambda train, horizon: np.arange(1, horizon + 1) * 10.0 + len(train)
    df = series.history_series(wide(spark, [("A", [1.0] * 12)]))
    got = backtest.test_set_forecasts_python(df, {"m": seen}).orderBy("Origin").collect()
    assert [r.Forecast for r in got] == [46, 47, 48]
    full = backtest.model_forecasts(df, {"m": seen}, 2).orderBy("Horizon").collect()
    assert [(r.Target_Month, r.Forecast) for r in full] == [
        (dt.date(2020, 1, 1), 22), (dt.date(2020, 2, 1), 32),
    ]


def test_export(spark):
    df = spark.createDataFrame(
        [("A", "m", dt.date(2020, 1, 1), 2.5), ("A", "m", dt.date(2020, 2, 1), -3.0),
         ("A", "n", dt.date(2020, 1, 1), 9.0)],
        "SKU string, Model string, Target_Month date, Forecast double",
    )
    out = backtest.forecast_export(df, "m", dt.date(2019, 12, 1), 2)
    assert out.columns == ["Item Number", "Series / Time", "1/1/2020", "2/1/2020"]
    assert [tuple(r) for r in out.collect()] == [("A", "Custom Stat", 2, 0)]


ACC = (
    "SKU string, Month_Year string, Cost double, Adj_FC_Units double, Adj_FC_Cost double, "
    "Adj_Orders_Units double, Adj_Orders_Cost double, Stat_FC_Units double, Stat_FC_Cost double"
)
TEST = "SKU string, Model string, Month string, Forecast double"


@pytest.fixture
def scored(spark):
    test = spark.createDataFrame(
        [("A", m, mo, f) for m, f in (("x", 8.0), ("y", 10.0)) for mo in ("Jan_2020", "Feb_2020")]
        + [("B", "x", "Jan_2020", 1.0), ("B", "y", "Jan_2020", 1.0)]
        + [("Z", "x", "Jan_2020", 1.0)],
        TEST,
    )
    acc = spark.createDataFrame(
        [("A", "Jan_2020", 2.0, 12.0, 24.0, 10.0, 20.0, 10.0, 20.0),
         ("B", "Jan_2020", 1.0, 5.0, 5.0, 0.0, 0.0, 3.0, 3.0)],
        ACC,
    )
    return test, acc


def test_scoring(scored):
    test, acc = scored
    rows = scoring.scoring_rows(test, acc)
    got = {(r.SKU, r.Model, r.Month_Year, r.Kind): r for r in rows.collect()}
    # item Z has no accuracy data; item A's February keeps its row without errors
    assert {k[0] for k in got} == {"A", "B"} and len(got) == 18
    assert got["A", "x", "Jan_2020", "Test"].Acc_Units == 80
    assert got["A", "x", "Jan_2020", "Test"].Fcst_Cost == 16
    assert got["A", "x", "Jan_2020", "Sales"].Error_Cost == -4
    assert got["A", "x", "Feb_2020", "Test"].Error_Units is None
    assert got["B", "x", "Jan_2020", "Test"].Acc_Units is None

    totals = scoring.sku_totals(rows)
    best = {r.SKU: r for r in scoring.best_model_per_sku(totals, ["x", "y"]).collect()}
    # stat and model y both reach 100; the smaller name wins
    assert best["A"].Best_Model == "Stat_Acc_Cost" and best["A"].x_Test_Set_Acc_Cost == 80
    assert best["B"].Best_Model is None

    summary = scoring.model_summary(rows, ["Jan_2020", "Feb_2020"]).collect()
    # A: errors 4, 4, 0, 0 in cost; B adds 5, 1, 3, 1 on no orders
    by_name = {r.Model: r for r in summary}
    assert set(by_name) == {"x_Test_Set", "y_Test_Set", "Sales_Forecast", "Stat_Forecast"}
    assert by_name["x_Test_Set"].Total_ABS_Error_Cost == 5
    assert by_name["x_Test_Set"].Jan_2020_cost == 75
    assert by_name["x_Test_Set"].Feb_2020_cost is None
    assert [r.Total_Acc_Cost for r in summary] == [95, 85, 75, 55]
    assert [r.SKU for r in scoring.excluded_skus(test, acc).collect()] == ["Z"]


def exact(df):
    measures = [f"{m}_{b}" for b in scoring.BASES for m in scoring.MEASURES]
    keys = ["SKU", "Model", "Month_Year", "Kind"]
    sums = df.groupBy(*keys).agg(*[
        F.sum(F.col(m).cast("decimal(28,10)")).alias(m) for m in measures
    ])
    return sorted(map(repr, sums.select(*keys, *measures).collect()))


def test_sums_agree_with_scored_rows(spark, scored):
    """Also with repeated and unknown months, repeated lines, null cells and models of other months."""
    test, acc = scored
    more = spark.createDataFrame(
        [("A", "x", "Jan_2020", 8.0), ("A", "x", "Jan_2020", None), ("A", "z", "Mar_2020", 3.0),
         ("A", "z", None, 3.0), (None, "z", "Jan_2020", 3.0), ("B", "z", "Feb_2020", 0.1)], TEST)
    lines = spark.createDataFrame(
        [("A", "Jan_2020", None, 1.1, None, 0.7, 0.3, None, 2.5),
         ("A", "Jan_2020", 2.0, 12.0, 24.0, 10.0, 20.0, 10.0, 20.0),
         ("B", "Feb_2020", 1.0, None, None, None, None, None, None),
         (None, "Jan_2020", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)], ACC)
    test, acc = test.unionByName(more), acc.unionByName(lines)
    sums = scoring.scored_sums(test, acc)
    assert exact(sums) == exact(scoring.scoring_rows(test, acc))
    assert sums.where("Model = 'x' AND SKU = 'A' AND Month_Year = 'Jan_2020'").count() == 7


def test_sums_of_nothing(spark, scored):
    test, acc = scored
    assert scoring.scored_sums(test.where("false"), acc).count() == 0
    assert scoring.scored_sums(test, acc.where("false")).count() == 0


def test_sums_score_only_own_forecasts_by_line(spark):
    """Rows joined line by line grow with the models, the sums of the other two kinds do not."""
    acc = spark.createDataFrame([("A", "Jan_2020", 1.0, 1.0, 1.0, 2.0, 2.0, 1.0, 1.0)] * 50, ACC)
    test = spark.createDataFrame([("A", f"m{i}", "Jan_2020", 1.0) for i in range(4)], TEST)
    sums = scoring.scored_sums(test, acc)
    assert sums.count() == 12
    assert sums._jdf.queryExecution().executedPlan().toString().count("Generate") == 1


def fails_below(limit):
    def model(train, horizon):
        if train[-1] < limit:
            raise ValueError(f"{train[-1]:.0f} is low")
        return np.full(horizon, train[-1])

    return model


def test_model_that_fails_on_some_items(spark):
    df = series.history_series(wide(spark, [("A", [9.0] * 12), ("B", [1.0] * 12)]))
    one = fails_below(5)
    matrix = models.Batched(lambda t, h: np.stack([one(x, h) for x in t]))
    short = lambda t, h: np.zeros(h - 1)
    chosen = {"one": one, "all": matrix, "short": short}
    got = backtest.test_set_forecasts_python(df, chosen, 1, 3, errors=True).collect()
    assert {(r.SKU, r.Model): (r.Forecast, r.Error) for r in got} == {
        ("A", "one"): (9, None), ("B", "one"): (None, "ValueError: 1 is low"),
        ("A", "all"): (9, None), ("B", "all"): (None, "ValueError: 1 is low"),
        ("A", "short"): (None, "ValueError: 4 forecasts asked, shape (3,) given"),
        ("B", "short"): (None, "ValueError: 4 forecasts asked, shape (3,) given"),
    }
    full = backtest.model_forecasts(df, {"all": matrix}, 2, errors=True).collect()
    assert sorted((r.SKU, r.Horizon or 0, r.Forecast, r.Error) for r in full) == [
        ("A", 1, 9, None), ("A", 2, 9, None), ("B", 0, None, "ValueError: 1 is low"),
    ]
    with pytest.raises(Exception, match="one on item B: ValueError: 1 is low"):
        backtest.model_forecasts(df, {"one": one}, 2).collect()


def test_batched_models_get_equally_long_series():
    seen = []

    def fit(trains, steps):
        seen.append(trains.shape)
        return np.repeat(trains[:, -1:], steps, axis=1)

    trains = [np.arange(n, dtype=float) for n in (3, 2, 3, 0, 2, 3)]
    got = models.fit_all(models.Batched(fit), trains, 2)
    assert sorted(set(seen)) == [(1, 0), (2, 2), (3, 3)]
    assert [None if f.error else f.values.tolist() for f in got] == [
        [2, 2], [1, 1], [2, 2], None, [1, 1], [2, 2],
    ]
    assert models.fit_all(models.Batched(fit), [], 2) == []


def test_detail_keeps_every_row(spark, scored):
    test, acc = scored
    # one item and model holds nearly all rows, some of them equal
    many = spark.range(500).selectExpr(
        "'A' SKU", "'Jan_2020' Month_Year", "2D Cost", "12D Adj_FC_Units", "24D Adj_FC_Cost",
        "10D Adj_Orders_Units", "double(id div 5) Adj_Orders_Cost", "1D Stat_FC_Units",
        "2D Stat_FC_Cost",
    )
    rows = scoring.scoring_rows(test, acc.unionByName(many))
    nested = scoring.sku_detail_nested(rows)
    keys = list(scoring.DETAIL_KEYS)
    back = nested.selectExpr(*keys, "explode(Detail) d").selectExpr(*keys, "d.*")
    assert back.agg({"Copies": "sum"}).first()[0] == rows.count()
    assert nested.count() == nested.select(*keys).distinct().count()
    assert nested.where("SKU = 'A' AND Month_Year = 'Jan_2020'").selectExpr("max(size(Detail))").first()[0] > 90


def test_accuracy_data(spark):
    rep = spark.createDataFrame(
        [(2020, "JANUARY", "USA", "S", 1.005, d, c, 1.0, 2.5, 3.0, 3.5) for d, c in
         (("GOL", "me"), ("SOC", "me"), ("WAT", "me"), ("GOL", "you"))]
        + [(2020, "MARCH", "USA", "S", 1.0, "GOL", "me", 1.0, 1.0, 1.0, 1.0)],
        "Year int, Month string, Country string, `SKU Number` string, Cost double, Division string,"
        "Customer string, `Adjusted FC - Units` double, `Adjusted FC - Cost` double,"
        "`Adjusted Orders - Units` double, `Adjusted Orders - Cost` double",
    )
    stat = spark.createDataFrame(
        [(2020, "JANUARY", "USA", "S", "all", "me", None, 4.5)],
        "Year int, Month string, Country string, `SKU Number` string, Division string,"
        "Customer string, `Stat Forecast Units` double, `Stat Forecast Cost` double",
    )
    got = scoring.accuracy_data(rep, stat, "me", ["GOL", "SOC"], "USA").collect()
    assert [(r.Division, r.Month_Year) for r in sorted(got, key=lambda r: r.Division)] == [
        ("GOL", "Jan_2020"), ("SOC", "Jan_2020"),
    ]
    r = got[0]
    assert (r.Cost, r.Adj_FC_Cost, r.Adj_Orders_Cost, r.Stat_FC_Units, r.Stat_FC_Cost) == (
        1.0, 2, 4, 0, 4,
    )

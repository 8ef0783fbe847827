"""Rounding, division and missing-value rules, worked by hand."""

import pytest
from pyspark.sql import functions as F

from demandmill.functions import rules
from demandmill.operators import pos


def one(spark, column, **values):
    schema = ", ".join(
        f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in values.items()
    )
    df = spark.createDataFrame([tuple(values.values())], schema)
    return df.select(column.alias("r")).first().r


@pytest.mark.parametrize(
    "x,digits,want",
    [(0.5, 0, 0), (1.5, 0, 2), (2.5, 0, 2), (-2.5, 0, -2), (2.675, 2, 2.68), (0.125, 2, 0.12),
     (99.875, 2, 99.88), (None, 0, None)],
)
def test_half_even(spark, x, digits, want):
    assert one(spark, rules.half_even("x", digits), x=x) == want


def test_ratio_of_zero_base_is_unknown(spark):
    assert one(spark, rules.ratio(F.col("a"), F.col("b")), a=1.0, b=0.0) is None
    assert one(spark, rules.ratio(F.col("a"), F.col("b")), a=0.0, b=0.0) is None


@pytest.mark.parametrize(
    "error,base,want", [(5.0, 0.0, 0.0), (0.0, 0.0, None), (5.0, 2.0, 0.0), (1.0, 4.0, 0.75),
                        (None, 4.0, None), (1.0, None, None)]
)
def test_clamped_accuracy(spark, error, base, want):
    got = one(spark, rules.clamped_accuracy(F.col("e"), F.col("b")), e=error, b=base)
    assert got == want


def test_totals(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), ("c", 2.0)], "k string, v double")
    got = {
        r.k: (r.exact, r.known, r.strict)
        for r in df.groupBy("k").agg(
            rules.exact_total("v").alias("exact"), rules.exact_sum("v").alias("known"),
            rules.strict_sum("v").alias("strict"),
        ).collect()
    }
    assert got == {"a": (1, 1, None), "b": (0, None, None), "c": (2, 2, 2)}


def test_exact_total_ignores_row_order(spark):
    rows = [(i * 0.01,) for i in range(1, 5001)]
    df = spark.createDataFrame(rows, "v double")
    sums = {
        df.repartition(n).agg(rules.exact_total("v").alias("s")).first().s for n in (1, 3, 7, 8)
    }
    assert sums == {125025.0}


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert {r.k for r in df.where(rules.not_in("k", ["a"])).collect()} == {"b", None}


def test_if_known(spark):
    c = rules.if_known(F.col("x") > 1, F.lit("y"), F.lit("n"))
    assert [one(spark, c, x=v) for v in (2.0, 0.0, None)] == ["y", "n", None]


def test_paste_writes_na(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(rules.paste("x", "y").alias("r")).first().r == "aNA"


def test_match_join_matches_null(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "kk string, w int")
    got = rules.match_join(left, right, [("k", "kk")])
    assert got.columns == ["k", "v", "w"]
    assert {(r.v, r.w) for r in got.collect()} == {(1, 10), (2, 20), (3, None)}


@pytest.mark.parametrize("n", [1, 3, 7, 16])
def test_sums_of_fractions_do_not_depend_on_partitions(spark, n):
    """Views, KPIs and segments of fractional units, dealt in different ways."""
    base = spark.range(20_000).selectExpr(
        "date'2020-01-01' Fcst_Date", "'January' Month", "2020 Year", "int(id % 3 + 1) Lag",
        "id % 5 = 0 Our_LT", "id * 0.1 / 3 Mean_Fcst", "id * 0.7 / 9 Mean_ABS_Error",
        "id * 1.3 / 7 Shipped_Units", "1 P70_Below", "0 P80_Below", "1 P90_Below",
        "concat('D', id % 4) DEMAND_CAT_CU", "concat('A', id % 3) ABC_REV_ITM_CU",
    )

    def results(df):
        tables = pos.accuracy_by_view(df), pos.kpi_totals(df), pos.accuracy_by_segment(df)
        return [sorted(map(tuple, t.collect()), key=repr) for t in tables]

    assert results(base.repartition(n)) == results(base.coalesce(1))

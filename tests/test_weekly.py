"""Weekly to monthly against a day-by-day computation."""

import calendar
import datetime as dt
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from demandmill.operators import weekly
from demandmill.sources.layouts import MEASURES, week_column

HEADS = [week_column(w, m) for m in MEASURES for w in range(1, 27)]


def file_of(spark, rows):
    """rows: (file date, ASIN, list of 104 texts)"""
    schema = "File_Date date, ASIN string, UPC string, Product_Title string, " + ", ".join(
        f"`{h}` string" for h in HEADS
    )
    return spark.createDataFrame([(d, a, "u", "t", *cells) for d, a, cells in rows], schema)


def run(spark, rows):
    got = weekly.weekly_to_monthly(file_of(spark, rows), F.col("File_Date"))
    return {
        (r.POS_Fcst_Version_Date, r.ASIN, r.Year, r.Month_Num): tuple(r[m] for m in MEASURES)
        for r in got.collect()
    }


def by_day(rows):
    sums = defaultdict(lambda: [Fraction(0)] * 4)
    for date, asin, cells in rows:
        last = date + dt.timedelta(181)
        # first kept: first of next month; last kept: end of the month before the last day's
        first_kept = (date.replace(day=1) + dt.timedelta(32)).replace(day=1)
        last_kept = last.replace(day=1) - dt.timedelta(1)
        for i in range(182):
            day = date + dt.timedelta(i)
            if not first_kept <= day <= last_kept:
                continue
            key = (date, asin, day.year, day.month)
            for m in range(4):
                text = cells[m * 26 + i // 7].replace(",", "")
                if text == "—" or sums[key][m] is None:
                    sums[key] = [None if k == m else v for k, v in enumerate(sums[key])]
                else:
                    value = sums[key][m] + Fraction(text) / 7
                    sums[key] = [value if k == m else v for k, v in enumerate(sums[key])]
    return {
        k: tuple(None if v is None else float(round(v)) for v in vs) for k, vs in sums.items()
    }


def test_against_days(spark):
    rng = random.Random(7)
    dates = [dt.date(2020, 4, 13), dt.date(2019, 12, 31), dt.date(2020, 6, 1), dt.date(2020, 1, 31),
             dt.date(2020, 2, 29), dt.date(2019, 11, 4)]
    rows = []
    for d in dates:
        for k in range(4):
            cells = [f"{rng.randrange(0, 4_000_000) / 100:,.2f}" for _ in HEADS]
            if k == 3:
                cells[rng.randrange(len(cells))] = "—"
            rows.append((d, f"A{k}", cells))
    assert run(spark, rows) == by_day(rows)


@pytest.mark.parametrize(
    "date,months",
    [
        (dt.date(2020, 4, 13), [5, 6, 7, 8, 9]),
        # The last day, 2020-07-31, ends its month; that month is dropped all the same.
        (dt.date(2020, 2, 1), [3, 4, 5, 6]),
    ],
)
def test_kept_months(spark, date, months):
    got = run(spark, [(date, "A", ["7"] * 104)])
    assert sorted(k[3] for k in got) == months
    for (_, _, year, month), values in got.items():
        assert values == (calendar.monthrange(year, month)[1],) * 4


def test_equal_rows_add_up_and_one_unknown_spoils(spark):
    d = dt.date(2020, 4, 13)
    full, hole = ["7"] * 104, ["7"] * 104
    hole[10] = ""
    twice = run(spark, [(d, "A", full), (d, "A", full)])
    assert twice[(d, "A", 2020, 6)] == (60,) * 4
    one_hole = run(spark, [(d, "A", full), (d, "A", hole)])
    # week 11 of the mean runs from 2020-06-22 to 2020-06-28
    assert one_hole[(d, "A", 2020, 6)] == (None, 60, 60, 60)
    assert one_hole[(d, "A", 2020, 7)] == (62,) * 4


def test_long_and_wide_are_inverse(spark):
    rows = [(dt.date(2020, 4, 13), a, [str(i) for i in range(104)]) for a in "AB"]
    wide = weekly.weekly_to_monthly(file_of(spark, rows), F.col("File_Date"))
    back = weekly.combine_forecast_measures([weekly.forecasts_long(wide)])
    assert sorted(back.select(wide.columns).collect()) == sorted(wide.collect())


def test_too_many_weeks(spark):
    df = spark.createDataFrame([("a", "b", "c", "1")], "ASIN string, UPC string, Product_Title string, `Week 27 - Mean Forecast` string")
    with pytest.raises(ValueError, match="27"):
        weekly.weekly_cells(df, F.current_date())


def test_a_seventh_is_rounded_on_the_exact_remainder(spark):
    from fractions import Fraction

    texts = ["3.5", "10.5", "17.5", "-3.5", "-10.5", "3.4999999999", "3.5000000001", "0", "7", "-0.0000000001",
             "24.5", "7378697629483820.5", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "cast(t as decimal(38,10)) x")
    got = {r.t: r.y for r in df.select("t", weekly.seventh(F.col("x")).alias("y")).collect()}
    assert got[None] is None
    assert all(got[t] == round(Fraction(t) / 7) for t in texts if t)

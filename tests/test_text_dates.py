import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandmill.functions import dates, text
from demandmill.sources import readers


def read(spark, column, *cells):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    return [r.r for r in df.select("i", column.alias("r")).orderBy("i").collect()]


def test_money(spark):
    cells = ("$1,234.50", "(5)", "—", "", None, "5d", "NaN", " 7 ", "1e3", "-2")
    assert read(spark, text.money("c"), *cells) == [
        1234.5, 5, None, None, None, None, None, 7, 1000, -2,
    ]
    assert read(spark, text.money("c", paren_negative=True), "($1,234.50)", "5") == [-1234.5, 5]


def test_percent(spark):
    assert read(spark, text.percent_text("c"), "12.5%", "1,234%", "x") == [0.125, 12.34, None]
    assert read(spark, text.plain_percent_text("c"), "12.5%", "1,234%") == [0.125, None]
    assert read(spark, text.count_text("c"), "1,234", "$5") == [1234, None]


def test_nul_bytes(spark):
    assert read(spark, text.without_nul("c"), "a\u0000b") == ["ab"]


@pytest.mark.parametrize(
    "raw,want",
    [(" do it best corp ", "DO IT BEST"), ("All Other - (G45)", "ALL OTHER"),
     (" All Other - (G45)", "ALL OTHER - (G45)"), ("Meijer Inc", "MEIJER"),
     ("orgill west\t", "ORGILL"), ("my true value", "TRUE VALUE"), ("other", "OTHER"),
     (None, None)],
)
def test_customer(spark, raw, want):
    assert read(spark, text.canonical_customer("c"), raw) == [want]


def test_monthly_file_name(spark):
    path = "/drop/Report With UPC_June_2020.csv"
    cols = readers.month_columns("c")
    assert read(spark, cols["Date"], path, "/drop/UPC_Foo_2020.csv", "none") == [
        dt.date(2020, 6, 1), None, None,
    ]
    assert read(spark, cols["Month"], path) == ["June"]
    assert read(spark, cols["Year"], path) == ["2020"]


def test_weekly_file_name(spark):
    assert read(spark, readers.date_in_name("c"), "/x/Weekly_04_13_2020.csv", "/x/13_40_2020.csv") == [
        dt.date(2020, 4, 13), None,
    ]


def test_parse_mdy(spark):
    assert read(spark, dates.parse_mdy("c"), "1/5/2020", "01/05/2020", "x") == [
        dt.date(2020, 1, 5), dt.date(2020, 1, 5), None,
    ]


def test_month_names(spark):
    assert read(spark, dates.month_number("c"), "June", "Juno", None) == [6, None, None]
    assert read(spark, dates.month_full("c"), "Sep") == ["September"]
    assert read(spark, dates.month_short("c"), "September") == ["Sep"]
    assert read(spark, dates.upper_month_label("c", F.lit(2020)), "JANUARY") == ["Jan_2020"]


def test_lag(spark):
    version = F.lit(dt.date(2020, 4, 13))
    lag = dates.month_lag(version, F.to_date("c"))
    months = [f"2020-0{m}-01" for m in range(5, 10)]
    assert read(spark, lag, *months) == [1, 2, 3, 4, 5]


def test_trailing_year():
    assert dates.trailing_year(dt.date(2020, 1, 20)) == (dt.date(2019, 1, 1), dt.date(2019, 12, 1))

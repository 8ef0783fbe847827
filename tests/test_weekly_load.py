"""What a load of weekly files does per file, per item and per month, and that odd cells come out the same."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_files import HEADER, drop_folder, weekly_file
from test_growth import plan
from test_weekly import by_day, file_of

from demandmill.operators import weekly
from demandmill.session import METHOD_LIMIT, short_methods
from demandmill.sources import readers
from demandmill.sources.layouts import MEASURES
from demandmill.streaming import ingest

DAY = dt.date(2020, 4, 13)


def test_an_items_rows_are_added_up_before_its_months_become_rows(spark):
    text = plan(weekly.weekly_to_monthly(file_of(spark, [(DAY, "A", ["7"] * 104)]), F.col("File_Date")))
    assert text.index("Generate inline") < text.index("HashAggregate")


def test_whole_rows_are_bigints_and_others_exact(spark):
    odd, large, hole = ["7"] * 104, ["7"] * 104, ["7"] * 104
    odd[8], large[8], hole[8] = "0.35", "1,000,000,000", "—"
    rows = [(DAY, a, x) for a, x in (("A", ["7"] * 104), ("B", odd), ("C", large), ("D", hole))]
    sums = weekly.unit_sums(weekly.weekly_cells(file_of(spark, rows), F.col("File_Date")))
    got = {r.ASIN: r for r in sums.collect()}
    assert dict(sums.dtypes)["Mean_Fcst_0"] == "bigint"
    assert [a for a in "ABCD" if got[a][weekly.EXACT_SUMS] is None] == ["A", "D"]
    assert (got["A"].Mean_Fcst_0, got["D"].Mean_Fcst_1, got["D"].P70_Fcst_1) == (217, None, 210)
    whole = sums.where("ASIN IN ('A', 'D')")
    fast, exact = (weekly.sums_to_monthly(whole, units=u).collect() for u in (True, False))
    assert sorted(map(str, fast)) == sorted(map(str, exact))


def test_a_seventh_of_a_whole_number(spark):
    numbers = [0, 1, 3, 4, 7, 10, 11, -3, -4, -10, 2**40 + 1, 2**60 + 3, None]
    df = spark.createDataFrame([(x,) for x in numbers], "x bigint")
    got = {r.x: r.y for r in df.select("x", weekly.seventh_of_whole(F.col("x")).alias("y")).collect()}
    assert all(got[x] == float(round(x / 7) if abs(x) < 2**50 else (x + 3) // 7) for x in numbers if x is not None)
    assert got[None] is None


@pytest.mark.parametrize("value", ["1,400", "1,400.25"])
def test_loaded_months_are_those_of_the_days(spark, tmp_path, value):
    """Whole numbers and others, an item twice in a file, and a file without a date."""
    drop, out, state = drop_folder(tmp_path)
    cells = [*["5"] * 13, "Core", *["7"] * 104, *[""] * 14]
    again = ",".join(["B1", "0B1", "TT", *cells])
    weekly_file(tmp_path / "drop" / "Weekly_04_13_2020.csv", "B1", value, [again])
    weekly_file(tmp_path / "drop" / "Weekly.csv", "B1", "7")
    ingest.ingest_weekly(spark, drop, out, state).awaitTermination()
    got = {
        (r.POS_Fcst_Version_Date, r.ASIN, r.Year, r.Month_Num): tuple(r[m] for m in MEASURES)
        for r in ingest.published_forecast(spark, out).collect()
    }
    assert got == by_day([(DAY, "B1", [value] * 104), (DAY, "B1", ["7"] * 104)])
    for table in ("forecast", "inventory"):
        stored = spark.read.parquet(f"{out}/{table}").select(readers.PATH).distinct().collect()
        assert [r[0].split("/")[-1] for r in stored] == ["Weekly_04_13_2020.csv"]


@pytest.mark.parametrize("most", [8, 1])
def test_few_orders_need_no_join(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(readers, "MOST_ORDERS", most)
    cells = dict(zip(HEADER, ["B1", "0B1", "T\u0000T", *["5"] * 13, "Core", *map(str, range(104)), *[""] * 14]))
    for n, order in enumerate([HEADER, [*HEADER[:3], *HEADER[:2:-1]], [*HEADER[:3], *HEADER[10:], *HEADER[3:10]]]):
        lines = [",".join(order), ",".join(cells[c] for c in order)]
        (tmp_path / f"Weekly_04_{13 + n}_2020.csv").write_text("\n".join(lines) + "\n")
    raw = readers.read_weekly(spark, str(tmp_path))
    text = plan(raw)
    assert text.count("FileScan csv") == 1 and ("Join" in text) == (most == 1)
    rows = raw.drop(readers.PATH).collect()
    assert len(rows) == 3 and len(set(rows)) == 1 and rows[0].Product_Title == "TT"
    assert rows[0]["Week 2 - P70 Forecast"] == "27"


def test_a_longer_file_goes_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(ingest, "tasks_for", lambda df: 8)
    loading = spark.createDataFrame([("a", "A", 1, 700), ("b", "B", 1, 100)], ingest.STATES)
    rows = spark.range(400).selectExpr("id", "IF(id % 2 = 0, 'A', 'B') AS File_Id")
    made = ingest.in_buckets(rows, ["id"], loading)
    assert made.count() == 400
    assert {r.File_Id: r.n for r in made.groupBy("File_Id").agg(F.countDistinct(ingest.BUCKET).alias("n")).collect()} == {
        "A": 7, "B": 1,
    }


def test_the_method_limit_is_as_before_afterwards(spark):
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, "65535")
    try:
        with pytest.raises(ZeroDivisionError), short_methods(spark):
            assert spark.conf.get(METHOD_LIMIT) == "8000"
            raise ZeroDivisionError
        assert spark.conf.get(METHOD_LIMIT) == "65535"
    finally:
        spark.conf.set(METHOD_LIMIT, before)

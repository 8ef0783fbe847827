"""What travels and what a task holds as tables grow: read off the plans, and results that must not change."""

import datetime as dt
import gzip
import re

import pytest
from pyspark.sql import functions as F
from test_files import weekly_file
from test_weekly import by_day, file_of, run

from demandmill import session
from demandmill.functions.rules import match_join
from demandmill.operators import scoring, series, weekly
from demandmill.plans import inputs
from demandmill.plans.catalog import QUERIES
from demandmill.sources import readers
from demandmill.streaming import ingest


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("make", [inputs.weekly_raw, inputs.history_wide])
def test_only_narrow_rows_travel(spark, sf, make):
    text = plan(make(spark, sf))
    assert "pivotfirst" not in text
    assert text.count("Exchange") == 1


def test_spread_keeps_unknown_names_and_values(spark, tmp_path):
    rows = [(1, 1, 2.0), (1, 1, 3.0), (1, 2, None), (2, None, 4.0), (None, 2, 5.0)]
    spark.createDataFrame(rows, "k long, n int, x double").write.parquet(f"{tmp_path}/t")
    got = inputs.spread(spark.read.parquet(f"{tmp_path}/t"), ["k"], "n", [1, 2], "x").collect()
    assert {tuple(r) for r in got} == {(1, 5.0, None), (2, None, None), (None, None, 5.0)}


def test_an_item_travels_as_one_row(spark, sf):
    text = plan(weekly.weekly_to_monthly(inputs.weekly_raw(spark, sf), F.col("File_Date")))
    assert text.index("Generate inline") < text.index("Exchange")


def test_measures_are_spread_in_one_shuffle(spark):
    long = spark.createDataFrame(
        [("a", "Mean_Fcst", 1.0), ("a", "P70_Fcst", None), ("a", "P70_Fcst", 2.0)],
        "k string, POS_Forecast_Type string, POS_Forecast double",
    )
    wide = weekly.combine_forecast_measures([long])
    assert plan(wide).count("Exchange") == 1
    assert [tuple(r) for r in wide.collect()] == [("a", 1.0, 2.0, None, None)]


def test_whole_and_other_numbers_in_one_month(spark):
    d = dt.date(2020, 4, 13)
    whole, mixed = ["1,000"] * 104, ["1,000"] * 104
    mixed[8], mixed[40] = "0.35", "2000000000000.5"
    rows = [(d, "A", whole), (d, "B", mixed), (d, "C", mixed)]
    assert run(spark, rows) == by_day(rows)
    sums = weekly.month_sums(weekly.weekly_cells(file_of(spark, rows), F.col("File_Date")))
    assert dict(sums.dtypes)["Mean_Fcst_0"] == weekly.SUMS


def test_tasks_grow_with_the_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(2000).repartition(2).write.parquet(path)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.tasks_for(spark.read.parquet(path)) == least
    monkeypatch.setattr(session, "BYTES_PER_TASK", 100)
    assert session.tasks_for(spark.read.parquet(path)) > least


def test_scoring_is_dealt_out_by_the_size_of_its_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "BYTES_PER_TASK", 100)
    test = "SKU string, Model string, Month string, Forecast double"
    spark.createDataFrame([("S", "m", "Jan_2020", 1.0)], test).write.parquet(f"{tmp_path}/t")
    acc = "SKU string, Month_Year string, " + ", ".join(f"{c} double" for c in scoring.ACTUAL[2:])
    lines = spark.createDataFrame([("S", "Jan_2020", *[1.0] * 7)], acc)
    tests = spark.read.parquet(f"{tmp_path}/t")
    tasks = session.tasks_for(tests)
    for made in (scoring.scored_sums(tests, lines), scoring.scoring_rows(tests, lines)):
        dealt = [x for x in plan(made).splitlines() if f", {tasks})" in x.replace("),", ",") or f", {tasks})," in x]
        assert len(dealt) >= 2
        assert made.count() == 3


def test_packed_files_are_loaded(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    weekly_file(drop / "Weekly_04_13_2020.csv", "B1", "7")
    weekly_file(tmp_path / "x.csv", "B2", "14")
    packed = drop / "Weekly_04_20_2020.csv.gz"
    packed.write_bytes(gzip.compress((tmp_path / "x.csv").read_bytes()))
    assert readers.first_line(spark, str(packed)) == readers.first_line(spark, str(tmp_path / "x.csv"))
    out = str(tmp_path / "out")
    ingest.ingest_weekly(spark, str(drop), out, str(tmp_path / "state")).awaitTermination()
    got = ingest.published_forecast(spark, out).select("ASIN", weekly.VERSION).distinct().collect()
    assert {tuple(r) for r in got} == {("B1", dt.date(2020, 4, 13)), ("B2", dt.date(2020, 4, 20))}
    assert not ingest.files_to_load(spark, str(drop), out).count()


def test_stored_rows_stay_where_they_are(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    weekly_file(drop / "Weekly_04_13_2020.csv", "B1", "7")
    out = str(tmp_path / "out")
    ingest.ingest_weekly(spark, str(drop), out, str(tmp_path / "state")).awaitTermination()
    assert "SortMergeJoin" not in plan(ingest.current_rows(spark, out, "inventory"))
    grouped = [x for x in plan(ingest.published_forecast(spark, out)).splitlines() if "Title" in x and "max_by" in x]
    assert grouped and not any("SortAggregate" in x for x in grouped)


def dealings(df):
    """Numbers of tasks that the shuffles of a plan deal rows out to."""
    return {int(x) for x in re.findall(r"Exchange hashpartitioning\(.*, (\d+)\)", plan(df))}


@pytest.fixture
def many_tasks(monkeypatch):
    """Files ask for more tasks than the setting has."""
    monkeypatch.setattr(session, "BYTES_PER_TASK", 1000)


@pytest.mark.parametrize("name", ["backtest_naive", "backtest_running", "backtest_python", "history_series"])
def test_series_lie_as_their_rows_were_dealt(spark, sf, many_tasks, name):
    made = QUERIES[name](spark, sf)
    tasks = session.tasks_for(inputs.table(spark, sf, "lineitem"))
    assert tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert plan(made).count("Exchange") == 1 and dealings(made) == {tasks}


@pytest.mark.parametrize("name", ["backtest_moving_avg", "backtest_seasonal_naive"])
def test_a_native_backtest_sends_its_source_rows_once(spark, sf, many_tasks, name):
    text = plan(QUERIES[name](spark, sf))
    assert text.count("Exchange") == 1 and "pivotfirst" not in text
    # Nothing is summed while a task still holds a split of the file.
    assert text.rindex("HashAggregate") < text.index("Exchange")
    tasks = session.tasks_for(inputs.table(spark, sf, "lineitem"))
    assert re.findall(r"Exchange hashpartitioning\(.*, (\d+)\)", text) == [str(tasks)]


def test_a_wide_table_in_files_is_dealt_out_by_item(spark, tmp_path, many_tasks):
    rows = [("A", "u", 1.0, None), ("A", "u", 2.0, 5.0), (None, "u", None, 3.0)]
    wide = "Item string, Measure string, `1/1/2020` double, `3/1/2020` double"
    spark.createDataFrame(rows, wide).write.parquet(f"{tmp_path}/w")
    table = spark.read.parquet(f"{tmp_path}/w")
    made = series.history_series(table)
    assert dealings(made) == {session.tasks_for(table)}
    got = {r["SKU"]: [p["History"] for p in r[series.SERIES]] for r in made.collect()}
    assert got == {"A": [3.0, 0.0, 5.0], None: [0.0, 0.0, 3.0]}


@pytest.mark.parametrize(
    "name", ["scoring_rows", "scoring_sku_totals", "best_model_per_sku", "sku_detail_nested", "excluded_skus"]
)
def test_no_step_of_scoring_keeps_to_the_setting(spark, sf, many_tasks, name):
    tasks = session.tasks_for(inputs.table(spark, sf, "lineitem"))
    assert dealings(QUERIES[name](spark, sf)) == {tasks}


@pytest.mark.parametrize("made", [inputs.accuracy_report, inputs.stat_report])
def test_reports_are_dealt_out_before_they_are_summed(spark, sf, many_tasks, made):
    text = plan(made(spark, sf))
    assert text.count("Exchange") == 1
    assert text.rindex("HashAggregate") < text.index("Exchange")


def test_a_scoring_run_deals_its_totals_out_as_its_rows(spark, sf, many_tasks, monkeypatch):
    asked = []
    for step in ("sku_totals", "excluded_skus", "scored_sums", "scoring_rows"):
        real = getattr(scoring, step)
        monkeypatch.setattr(scoring, step, lambda *a, f=real: asked.append(a[-1]) or f(*a))
    QUERIES["scoring_run"](spark, sf)
    assert asked == [session.tasks_for(inputs.table(spark, sf, "lineitem"))] * 4


def test_no_shuffle_by_item_of_a_scoring_run_keeps_to_the_setting(spark, sf, many_tasks):
    text = plan(QUERIES["scoring_run"](spark, sf))
    dealt = re.findall(r"Exchange hashpartitioning\((?:.*, )?SKU#.*, (\d+)\)", text)
    tasks = session.tasks_for(inputs.table(spark, sf, "lineitem"))
    assert len(dealt) >= 6 and set(dealt) == {str(tasks)}


def test_dealt_join_matches_null_with_null(spark):
    left = spark.createDataFrame([("a", 1, 1), (None, 1, 2), (None, None, 3), ("b", 1, 4)], "k string, n int, x int")
    right = spark.createDataFrame([("a", 1, 5), (None, 1, 6), (None, None, 7), (None, None, 8)], "j string, m int, y int")
    pairs = [("k", "j"), ("n", "m")]
    for how in ("inner", "left"):
        plain, dealt = (match_join(left, right, pairs, how, tasks=t) for t in (None, 20))
        assert dealt.columns == plain.columns
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    assert dealings(dealt) == {20}


def test_excluded_items_are_distinct_and_may_be_unknown(spark):
    items = lambda *names: spark.createDataFrame([(n,) for n in names], "SKU string")
    assert sorted(map(str, scoring.excluded_skus(items("a", "a", "b", "c", None), items("b", "d")).collect())) == [
        "Row(SKU='a')", "Row(SKU='c')", "Row(SKU=None)"
    ]
    assert scoring.excluded_skus(items("a", None), items("a", None, None)).collect() == []

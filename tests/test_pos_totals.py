import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandmill.operators import pos, pos_totals
from demandmill.sources import layouts, sinks
from test_pos import forecast, leads, shipped

ASOF = dt.date(2020, 10, 20)
MONTHS = [dt.date(2020, m, 1) for m in range(1, 10)]


@pytest.fixture
def tables(spark):
    versions = [dt.date(2020, m, 13) for m in range(1, 9)] + [dt.date(2020, 4, 9)]
    rows = [(v, a, m, 10.1 * m + len(a) + v.month) for v in versions for a in ("A", "BB", "CCC")
            for m in range(v.month + 1, min(v.month + 6, 10))]
    segment = "COMPANY string, CUSTOMER string, ITEM_NUMBER string, DEMAND_CAT_CU string, ABC_REV_ITM_CU string"
    return {
        "forecasts": forecast(spark, rows + rows[:5]),
        "leadtimes": leads(spark, [("A", "SA", 2, "COOKING", "x"), ("BB", "SB", 1, "CREATING", "y")]),
        "actuals": shipped(spark, [(m, a, 9.3 * m.month) for m in MONTHS for a in ("A", "BB")]),
        "segments": pos.segments_of(
            spark.createDataFrame([("c", "k", "SA", "Smooth", "A"), ("c", "k", None, "Lumpy", "B")], segment),
            "c", "k",
        ),
    }


def figures(rows):
    out = []
    for df in (pos.kpi_totals(rows), pos.accuracy_by_view(rows), pos.accuracy_by_segment(rows)):
        out.append(sorted(map(tuple, df.collect()), key=repr))
    return out


def direct(tables, asof=ASOF, dedupe=True):
    return figures(pos.pos_accuracy_base(
        tables["forecasts"], tables["leadtimes"], tables["actuals"], asof, tables["segments"], dedupe
    ))


def named(spark, root):
    return sinks.read_pointer(spark, root)["cells"]


@pytest.mark.parametrize("dedupe", [True, False])
def test_new_months_and_versions(spark, tables, tmp_path, dedupe):
    root, version = str(tmp_path), F.col("POS_Fcst_Version_Date")
    early = dt.date(2020, 8, 20)
    before = tables | {"forecasts": tables["forecasts"].where(version < "2020-07-01")}
    pos_totals.refresh(spark, root, **before, asof=early, dedupe=dedupe)
    assert figures(pos_totals.read_totals(spark, root)) == direct(before, early, dedupe)
    old = named(spark, root)
    # June loaded again, July and August are new: rows of other versions and known months are not looked at
    junk = F.when(version.between("2020-06-01", "2020-08-31") | (F.col("Month_Num") > 7), F.col("Mean_Fcst"))
    only = tables | {"forecasts": tables["forecasts"].withColumn("Mean_Fcst", F.coalesce(junk, F.lit(-1e9)))}
    pos_totals.refresh(
        spark, root, **only, asof=ASOF, versions=[dt.date(2020, m, 13) for m in (6, 7, 8)], dedupe=dedupe
    )
    want = direct(tables, ASOF, dedupe)
    assert figures(pos_totals.read_totals(spark, root)) == want and want[0]
    new = named(spark, root)
    assert new["2020-04~2020-06"] == old["2020-04~2020-06"] and new["2020-06~2020-07"] != old["2020-06~2020-07"]


def test_second_version_of_a_month_and_rows_that_go(spark, tables, tmp_path):
    """Equal rows of two versions of one month count once; a version loaded without rows has no cells."""
    root = str(tmp_path)
    april = F.month("POS_Fcst_Version_Date") == 4
    one = tables | {"forecasts": tables["forecasts"].where(F.col("POS_Fcst_Version_Date") != "2020-04-09")}
    pos_totals.refresh(spark, root, **one, asof=ASOF, dedupe=True)
    first = figures(pos_totals.read_totals(spark, root))
    pos_totals.refresh(spark, root, **tables, asof=ASOF, versions=[dt.date(2020, 4, 9)], dedupe=True)
    assert figures(pos_totals.read_totals(spark, root)) == first == direct(tables)
    gone = tables | {"forecasts": tables["forecasts"].where(~april)}
    pos_totals.refresh(spark, root, **gone, asof=ASOF, versions=[dt.date(2020, 4, 13)], dedupe=True)
    assert figures(pos_totals.read_totals(spark, root)) == direct(gone) != first
    assert not [c for c in named(spark, root) if c.startswith("2020-04")]


def test_corrected_actuals_and_rebuild(spark, tables, tmp_path):
    root = str(tmp_path)
    pos_totals.refresh(spark, root, **tables, asof=ASOF, dedupe=True)
    fixed = tables | {"actuals": tables["actuals"].withColumn(
        "Shipped_Units", F.when(F.month("Date") == 6, 1.0).otherwise(F.col("Shipped_Units")))}
    pos_totals.refresh(spark, root, **fixed, asof=ASOF, corrected=[dt.date(2020, 6, 30)], dedupe=True)
    assert figures(pos_totals.read_totals(spark, root)) == direct(fixed)
    other = fixed | {"leadtimes": leads(spark, [("A", "SA", 3, "COOKING", "x")])}
    pos_totals.refresh(spark, root, **other, asof=ASOF, dedupe=True, rebuild=True)
    assert figures(pos_totals.read_totals(spark, root)) == direct(other)


def test_months_past_the_window_and_no_rows(spark, tables, tmp_path):
    root = str(tmp_path)
    pos_totals.refresh(spark, root, **tables, asof=ASOF, dedupe=True)
    later = dt.date(2021, 7, 1)
    pos_totals.refresh(spark, root, **tables, asof=later, dedupe=True)
    assert figures(pos_totals.read_totals(spark, root)) == direct(tables, later)
    assert min(c.split("~")[1] for c in named(spark, root)) == "2020-07"
    none = tables | {"forecasts": tables["forecasts"].limit(0)}
    pos_totals.refresh(spark, f"{root}/none", **none, asof=ASOF, dedupe=True)
    assert pos_totals.read_totals(spark, f"{root}/none").count() == 0


def test_a_new_version_reads_its_own_partitions(spark, tables, tmp_path):
    path = str(tmp_path / "forecasts")
    sinks.write_partitions(tables["forecasts"], path, ["POS_Fcst_Version_Date"])
    stored = spark.read.schema(layouts.FORECAST_MONTHLY).parquet(path)
    rows = pos_totals.concerned(stored, [], [dt.date(2020, 8, 1)], MONTHS)
    assert {r.POS_Fcst_Version_Date for r in rows.collect()} == {dt.date(2020, 8, 13)}
    scan = rows._jdf.queryExecution().executedPlan().collectLeaves().head()
    own = stored.where("POS_Fcst_Version_Date = '2020-08-13'").select(F.input_file_name()).distinct().count()
    assert scan.metrics().apply("numFiles").value() == own < len(stored.inputFiles())

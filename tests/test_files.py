"""Reading, writing, publication and file-drop ingest."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from demandmill import session
from demandmill.operators import monthend, reports, weekly
from demandmill.plans import inputs
from demandmill.sources import layouts, readers, sinks
from demandmill.sources.layouts import MEASURES, week_column
from demandmill.streaming import ingest


def test_report_file(spark, tmp_path):
    folder = tmp_path / "a b"
    folder.mkdir()
    head = ",".join(f"col {i}" for i in range(14))
    row = '"B1","012","Title, ""big""",' + ",".join(['"1,234"'] + ["7"] * 10)
    (folder / "Reviews With UPC_June_2019.csv").write_text(f"﻿{head}\n{row}\n", "utf-8")
    (folder / "Reviews With UPC_May_2020.csv").write_text(f"{head}\n{row}\n", "utf-8")
    raw = readers.read_report(spark, f"{folder}/*.csv", layouts.REVIEWS)
    got = reports.clean_report(raw, layouts.REVIEWS).orderBy("Date").collect()
    assert [(r.Date, r.Month, r.Month_Num, r.Year) for r in got] == [
        (dt.date(2019, 6, 1), "June", 6, "2019"), (dt.date(2020, 5, 1), "May", 5, "2020"),
    ]
    assert (got[0].UPC, got[0].Product_Title) == ("012", 'Title, "big"')
    assert (got[0].Number_Customer_Reviews, got[0]["1_Star"]) == (1234, 7)


HEADER = (
    ["ASIN", "UPC", "Title"]
    + [f"plan {i}" for i in range(4, 18)]
    + [week_column(w, m) for m in MEASURES for w in range(1, 27)]
    + [f"unused {i}" for i in range(13)]
    + ["beyond"]
)


def weekly_file(path, asin, value, extra=()):
    cells = [asin, "0" + asin, "T\u0000T", *["5"] * 13, "Core", *[value] * 104, *[""] * 14]
    lines = [",".join(HEADER), ",".join(f'"{c}"' for c in cells), *extra]
    path.write_text("﻿" + "\n".join(lines) + "\n", "utf-8")


def test_weekly_file(spark, tmp_path):
    weekly_file(tmp_path / "Weekly_04_13_2020.csv", "B1", "1,400")
    raw = readers.read_weekly(spark, str(tmp_path))
    assert len(raw.columns) == 136 and raw.columns[:3] == ["ASIN", "UPC", "Product_Title"]
    monthly = weekly.weekly_to_monthly(raw, readers.date_in_name(readers.PATH))
    got = monthly.orderBy("Month_Num").collect()
    assert [(r.Month, r.Mean_Fcst) for r in got] == [
        ("May", 6200), ("June", 6000), ("July", 6200), ("August", 6200), ("September", 6000),
    ]
    assert (got[0].ASIN, got[0].Product_Title) == ("B1", "TT")
    inv = reports.clean_inventory(raw).first()
    assert (inv.Date, inv.Month, inv.Day) == (dt.date(2020, 4, 13), "April", 13)
    assert (inv.Per_Rep_OOS, inv.Ordered_Units, inv.Replenishment_Category) == (0.05, 5, "Core")


def test_byte_order_mark_names(spark, tmp_path):
    for n, mark in enumerate(("ï»¿", "\ufeff", "")):
        (tmp_path / f"{n}.csv").write_text(f"{mark}ASIN, UPC,x\n", "utf-8")
    (tmp_path / "3.csv").write_text("Product_Title,UPC,x\n")
    assert [readers.weekly_names(names) for _, names in readers.headers(spark, str(tmp_path))] == [
        ["ASIN", "UPC", "Product_Title"]] * 3 + [["Product_Title", "UPC", "x"]]


def test_partition_overwrite_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    may = spark.createDataFrame([(5, "a"), (5, "b")], "m int, x string")
    june = spark.createDataFrame([(6, "c")], "m int, x string")
    for df in (may, june, may, spark.createDataFrame([(6, "d")], "m int, x string")):
        sinks.write_partitions(df, path, ["m"])
    got = spark.read.parquet(path).collect()
    assert sorted((r.m, r.x) for r in got) == [(5, "a"), (5, "b"), (6, "d")]


def test_append_unique_twice_is_once(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "i int, s string")
    b = spark.createDataFrame([("x", 2), ("y", 3)], "s string, i int")
    once = sinks.append_unique(a, b)
    assert sorted(once.collect(), key=repr) == sorted(sinks.append_unique(once, b).collect(), key=repr)
    assert once.count() == 3


def test_append_new_reads_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "i int, s string, day date"
    day = lambda n: dt.date(2020, 1, n)
    first = [(1, "a", day(1)), (1, "a", day(1)), (2, None, day(2)), (3, "c", None)]
    second = [(2, None, day(2)), (4, "d", day(2)), (4, "d", day(2)), (3, "c", None), (5, "e", day(3))]
    sinks.append_new(spark, path, spark.createDataFrame(first, schema), ["day"])
    before = {f.name for f in (tmp_path / "t").rglob("*.parquet")}
    # a partition that the load does not fall in may even be unreadable
    for file in (tmp_path / "t" / "day=2020-01-01").glob("*.parquet"):
        file.rename(f"{file}.away")
        file.write_bytes(b"no parquet")
    sinks.append_new(spark, path, spark.createDataFrame(second, schema), ["day"])
    for file in (tmp_path / "t" / "day=2020-01-01").glob("*.away"):
        file.rename(str(file).removesuffix(".away"))
    rows = sinks.read_appended(spark, path, spark.createDataFrame([], schema).schema).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted({*first, *second}, key=repr)
    assert before <= {f.name for f in (tmp_path / "t").rglob("*.parquet")}
    sinks.append_new(spark, path, spark.createDataFrame(second, schema), ["day"])
    assert spark.read.parquet(path).count() == len(rows)


def test_rewrite_switches_at_the_end(spark, tmp_path):
    root = str(tmp_path / "v")
    assert sinks.read_pointer(spark, root) == {}
    sinks.rewrite(spark, root, lambda old: spark.createDataFrame([(1,)], "i int"))
    old = sinks.read_current(spark, root)
    with pytest.raises(ZeroDivisionError):
        sinks.rewrite(spark, root, lambda rows: 1 / 0)
    broken = lambda rows: rows.withColumn("i", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        sinks.rewrite(spark, root, broken)
    assert sinks.read_current(spark, root).first().i == 1
    sinks.rewrite(spark, root, lambda rows: rows.withColumn("i", F.col("i") + 1))
    assert sinks.read_current(spark, root).first().i == 2
    # a reader that began before the switch reads on
    assert old.first().i == 1
    sinks.drop_unnamed(spark, root)
    runs = {p.name for p in (tmp_path / "v").iterdir() if p.name.startswith("run-")}
    assert runs == {v for v in sinks.read_pointer(spark, root).values()}


def test_publish_over_new_year(spark, sf, tmp_path):
    root = str(tmp_path / "me")
    raw, deltas = inputs.month_end_raw(spark, sf), inputs.month_end_deltas(spark, sf)
    december, january, february = dt.date(2019, 12, 31), dt.date(2020, 1, 31), dt.date(2020, 2, 29)

    def publish(v, rework=monthend.rework_with):
        stamp = lambda df: monthend.latest_version(df).withColumn("ME_Version_Date", F.lit(v))
        r, d = stamp(raw), stamp(deltas)
        sinks.publish_month_end(monthend.month_end_deltas(r, d), lambda w: rework(r, w), root, v)

    csv = lambda name: spark.read.option("header", True).csv(sinks.published_path(spark, root, name))
    publish(december)
    assert csv("previous_month_csv").count() == 0
    publish(january)
    now, before = sinks.published_month(spark, root, january), sinks.previous_month(spark, root, january)
    assert now.count() == before.count() > 0
    assert {r[0] for r in before.select("ME_Version_Date").distinct().collect()} == {december}
    lines = csv("last_month_csv")
    assert "Actl_TP_Fcst_Delta" not in lines.columns and lines.count() == now.count()
    assert {r[0] for r in lines.select("ME_Version_Date").distinct().collect()} == {"01/31/2020"}
    assert csv("previous_month_csv").count() == before.count()
    # a run that breaks while its second output is written changes nothing that a reader sees
    named = sinks.read_pointer(spark, root)
    with pytest.raises(Exception, match="broken"):
        publish(february, lambda r, w: monthend.rework_with(r, w).withColumn(
            "Country", F.raise_error(F.lit("broken")).cast("string")))
    assert sinks.read_pointer(spark, root) == named and lines.count() == now.count()
    # the month again: its folder is another, the others stay
    publish(january)
    again = sinks.read_pointer(spark, root)
    assert again["monthly"]["2019-12"] == named["monthly"]["2019-12"]
    assert again["monthly"]["2020-01"] != named["monthly"]["2020-01"]


def test_export_name(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 31),)], "d date")
    assert df.select(sinks.export_name("d")).first()[0] == (
        "01-Reworked Month End Raw Data - January 2020.csv"
    )


def weekly_months(spark, out):
    df = ingest.published_forecast(spark, out)
    return {(r.POS_Fcst_Version_Date, r.ASIN, r.Month_Num): r.Mean_Fcst for r in df.collect()}


def drop_folder(tmp_path):
    (tmp_path / "drop").mkdir()
    return [str(tmp_path / x) for x in ("drop", "out", "state")]


def test_stream_of_weekly_files(spark, tmp_path):
    drop, out, state = drop_folder(tmp_path)

    def load():
        ingest.ingest_weekly(spark, drop, out, state).awaitTermination()
        return weekly_months(spark, out)

    weekly_file(tmp_path / "drop" / "Weekly_04_13_2020.csv", "B1", "7")
    first = load()
    assert first[dt.date(2020, 4, 13), "B1", 5] == 31 and len(first) == 5
    weekly_file(tmp_path / "drop" / "Weekly_04_20_2020.csv", "B1", "14")
    # a corrected file of the first version, and one more item in a third
    weekly_file(tmp_path / "drop" / "Weekly_fixed_04_13_2020.csv", "B1", "70")
    weekly_file(tmp_path / "drop" / "Weekly_more_04_13_2020.csv", "B2", "7")
    second = load()
    assert second[dt.date(2020, 4, 13), "B1", 5] == 310 and second[dt.date(2020, 4, 20), "B1", 5] == 62
    assert second[dt.date(2020, 4, 13), "B2", 5] == 31 and len(second) == 15
    assert spark.read.parquet(f"{out}/inventory").count() == 4
    # a backlog loaded at once, and loaded twice, gives the same
    for n, state in enumerate(["state2", "state3"]):
        ingest.ingest_weekly(spark, drop, out + "2", str(tmp_path / state)).awaitTermination()
        assert weekly_months(spark, out + "2") == second


def test_a_repeated_file_counts_once(spark, tmp_path):
    drop, out, state = drop_folder(tmp_path)
    weekly_file(tmp_path / "drop" / "Weekly_04_13_2020.csv", "B1", "7")
    weekly_file(tmp_path / "drop" / "Copy of Weekly_04_13_2020.csv", "B1", "7")
    ingest.ingest_weekly(spark, drop, out, state).awaitTermination()
    assert weekly_months(spark, out)[dt.date(2020, 4, 13), "B1", 5] == 31
    assert ingest.published_rows(spark, out, "inventory").count() == 1


def test_undated_files_are_listed(spark, tmp_path):
    drop, out, state = drop_folder(tmp_path)
    for name in ("no date.csv", "Weekly_13_45_2020.csv", "Weekly_04_13_2020.csv"):
        weekly_file(tmp_path / "drop" / name, "B1", "7")
    ingest.ingest_weekly(spark, drop, out, state).awaitTermination()
    assert len(weekly_months(spark, out)) == 5
    listed = {r.Source_File.split("/")[-1] for r in spark.read.parquet(f"{out}/undated").collect()}
    assert listed == {"no date.csv", "Weekly_13_45_2020.csv"}


def age(path, days):
    then = path.stat().st_mtime - 86_400 * days
    os.utime(path, (then, then))


def test_late_and_rewritten_files_are_loaded(spark, tmp_path):
    drop, out, state = drop_folder(tmp_path)
    a, b = (tmp_path / "drop" / f"Weekly_04_{d}_2020.csv" for d in (13, 20))

    def load():
        ingest.ingest_weekly(spark, drop, out, state).awaitTermination()
        inventory = ingest.published_rows(spark, out, "inventory")
        return weekly_months(spark, out), {(r.Date.day, r.ASIN) for r in inventory.collect()}

    weekly_file(a, "B1", "7")
    weekly_file(tmp_path / "drop" / "Weekly_old_04_13_2020.csv", "B3", "7")
    age(tmp_path / "drop" / "Weekly_old_04_13_2020.csv", 30)
    assert len(load()[0]) == 10
    # one file is new, one comes ten days late
    weekly_file(b, "B1", "14")
    weekly_file(tmp_path / "drop" / "Weekly_late_04_20_2020.csv", "B2", "7")
    age(tmp_path / "drop" / "Weekly_late_04_20_2020.csv", 10)
    months, inventory = load()
    assert len(months) == 20 and months[dt.date(2020, 4, 20), "B2", 5] == 31
    # rewritten under its name: other values and another item
    weekly_file(a, "B9", "70")
    months, inventory = load()
    assert months[dt.date(2020, 4, 13), "B9", 5] == 310
    assert (dt.date(2020, 4, 13), "B1", 5) not in months
    assert inventory == {(13, "B9"), (13, "B3"), (20, "B1"), (20, "B2")}
    # a file that is being written has no bytes yet: what was loaded stays
    a.write_text("")
    assert load()[1] == inventory
    # rewritten without rows
    a.write_text(",".join(HEADER) + "\n")
    months, inventory = load()
    assert inventory == {(13, "B3"), (20, "B1"), (20, "B2")} and len(months) == 15
    (tmp_path / "drop" / "Weekly_old_04_13_2020.csv").write_text(",".join(HEADER) + "\n")
    months, inventory = load()
    assert inventory == {(20, "B1"), (20, "B2")} and {v.day for v, *_ in months} == {20}
    assert ingest.files_to_load(spark, drop, out).count() == 0


def test_a_load_that_broke_is_done_again(spark, tmp_path, monkeypatch):
    drop, out, state = drop_folder(tmp_path)
    weekly_file(tmp_path / "drop" / "Weekly_04_13_2020.csv", "B1", "7")
    with monkeypatch.context() as broken:
        broken.setattr(ingest, "publish_rows", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.ingest_weekly(spark, drop, out, state)
    assert ingest.files_to_load(spark, drop, out).count() == 1
    ingest.ingest_weekly(spark, drop, out, state).awaitTermination()
    assert len(weekly_months(spark, out)) == 5
    assert ingest.published_rows(spark, out, "inventory").count() == 1


def test_files_come_in_groups_and_under_any_name(spark, tmp_path):
    drop, out, state = drop_folder(tmp_path)
    for n, name in enumerate(["a[1]", "b {x,y}", "c*", "d+e", "f%20g", "h?"]):
        weekly_file(tmp_path / "drop" / f"{name}_04_13_2020.csv", f"B{n}", "7")
    ingest.ingest_weekly(spark, drop, out, state, files_at_once=4).awaitTermination()
    assert len(weekly_months(spark, out)) == 30
    assert spark.read.parquet(f"{out}/files").agg(F.max("Load")).first()[0] == 2


def test_publishing_reads_only_its_dates(spark, tmp_path, monkeypatch):
    drop, out, state = drop_folder(tmp_path)
    for day in (13, 20):
        weekly_file(tmp_path / "drop" / f"Weekly_04_{day}_2020.csv", "B1", "7")
    ingest.ingest_weekly(spark, drop, out, state).awaitTermination()
    rows = ingest.current_rows(spark, out, "inventory", [dt.date(2020, 4, 20)])
    scan = next(x for x in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "Date#" in x and "FileScan" in x)
    assert "2020-04-20" in scan and "2020-04-13" not in scan
    assert rows.count() == 1


def test_headers_do_not_read_whole_files(spark, tmp_path):
    """No job reads lines, however large a file is."""
    head = ",".join(f"c{i}" for i in range(14))
    (tmp_path / "big.csv").write_text(head + "\n" + ("x" * 1000 + "\n") * 100_000)
    (tmp_path / "small.csv").write_text("\ufeffa, b\n1,2\n")
    (tmp_path / "empty.csv").write_text("")
    system = readers.first_line(spark, f"{tmp_path}/big.csv")
    assert system == head
    found = {path.split("/")[-1]: names for path, names in readers.headers(spark, str(tmp_path))}
    assert found == {"big.csv": head.split(","), "small.csv": ["a", "b"]}


def test_columns_in_another_order(spark, tmp_path):
    """Each file is read by its own header."""
    weekly_file(tmp_path / "Weekly_04_13_2020.csv", "B1", "7")
    swap = {"Mean": "P70", "P70": "Mean"}
    other = [
        n if " - " not in n else n.replace(n.split()[3], swap.get(n.split()[3], n.split()[3]))
        for n in HEADER
    ]
    cells = ["B1", "0B1", "T", *["5"] * 13, "Core", *["70"] * 26, *["7"] * 78, *[""] * 14]
    (tmp_path / "Weekly_04_20_2020.csv").write_text(",".join(other) + "\n" + ",".join(cells) + "\n")
    raw = readers.read_weekly(spark, str(tmp_path))
    monthly = weekly.weekly_to_monthly(raw, readers.date_in_name(readers.PATH))
    got = {(r.POS_Fcst_Version_Date.day, r.Month_Num): r for r in monthly.collect()}
    assert (got[13, 5].Mean_Fcst, got[13, 5].P70_Fcst) == (31, 31)
    assert (got[20, 5].Mean_Fcst, got[20, 5].P70_Fcst) == (31, 310)
    # both orders are one scan
    assert raw._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_other_columns_are_an_error(spark, tmp_path):
    weekly_file(tmp_path / "Weekly_04_13_2020.csv", "B1", "7")
    (tmp_path / "Weekly_04_20_2020.csv").write_text(",".join(HEADER[:-1] + ["odd"]) + "\nB1\n")
    with pytest.raises(ValueError, match="odd"):
        readers.read_weekly(spark, str(tmp_path))


def test_reports_under_different_headers_are_an_error(spark, tmp_path):
    head = [f"c{i}" for i in range(14)]
    (tmp_path / "R UPC_June_2019.csv").write_text(",".join(head) + "\n")
    (tmp_path / "R UPC_May_2019.csv").write_text(",".join(head[::-1]) + "\n")
    with pytest.raises(ValueError, match="different headers"):
        readers.read_report(spark, str(tmp_path), layouts.REVIEWS)


def test_stream_of_reports(spark, tmp_path):
    """Two files of one month in two runs: both stay."""
    drop, out, state = drop_folder(tmp_path)
    head = ",".join(f"c{i}" for i in range(14))
    for name, asin in (("R US UPC_June_2019.csv", "B"), ("R CA UPC_June_2019.csv", "C"), ("R.csv", "D")):
        (tmp_path / "drop" / name).write_text(f"{head}\n{asin},0,T,{','.join('7' * 11)}\n")
        ingest.ingest_reports(spark, drop, layouts.REVIEWS, out, state).awaitTermination()
    rows = ingest.published_rows(spark, out, "reports").collect()
    assert sorted((r.ASIN, r.Date, r["5_Stars"]) for r in rows) == [
        ("B", dt.date(2019, 6, 1), 7), ("C", dt.date(2019, 6, 1), 7),
    ]


def test_dates_come_from_the_file_name(spark):
    paths = [
        "/lake/2019/UPC_May_/Report With UPC_June_2020.csv", "/lake/2019/Report.csv", "/x/UPC_9_2020.csv",
        "/lake/04_13_2020.csv/part",
    ]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = df.select(readers.month_in_name("p"), readers.year_in_name("p"), readers.date_in_name("p")).collect()
    assert [tuple(r) for r in got] == [
        ("June", "2020", None), (None, None, None), (None, "2020", None), (None, None, None),
    ]


class Cluster:
    """A session of a cluster without the setting."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_shared_folder(spark):
    """The cluster's folder where it names one; never a folder of one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert session.shared_dir(spark) == (named or session.shared_dir(spark))
    with pytest.raises(ValueError):
        session.shared_dir(Cluster)

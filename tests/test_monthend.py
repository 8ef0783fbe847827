import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandmill.operators import harmonise, monthend
from demandmill.sources import layouts

DEC, JAN = dt.date(2019, 12, 31), dt.date(2020, 1, 31)
FEB, MAR = dt.date(2020, 2, 1), dt.date(2020, 3, 1)
CODE = "ALL OTHER - (G45)"


def rows(spark, *items):
    """items: dicts over a default row"""
    base = dict(
        ME_Version_Date=JAN, Country="USA", Division="d", Sales_Manager="m", Director="boss",
        Customer="c", SRP5="5", SRP7="7", Year=2020, Month="February", FC_Date=FEB, Month_No=2,
        Shipments=None, Forecast=None, Total_Possible=None, Delta=None, Actl_TP=None,
        Actl_TP_Fcst=None, Conversion_Rate=1.0, Month_Year=None, Key="k", Current_ME_Version="Y",
        Current_Month="N",
    )
    return spark.createDataFrame(
        [tuple({**base, **x}[f.name] for f in layouts.MONTH_END.fields) for x in items],
        layouts.MONTH_END,
    )


def test_newest_version_by_date(spark):
    raw = rows(
        spark,
        dict(ME_Version_Date=DEC, Actl_TP_Fcst=100.0),
        dict(Actl_TP_Fcst=1.0), dict(Actl_TP_Fcst=2.0, Shipments=5.0),
    )
    deltas = rows(spark, dict(ME_Version_Date=DEC, Delta=50.0), dict(Director=None, Delta=0.5))
    out = monthend.month_end_rework(raw, deltas)
    assert tuple(out.columns) == monthend.PUBLISHED
    (r,) = out.collect()
    assert (r.ME_Version_Date, r.Director, r.Month_Year) == (JAN, "boss", "February2020")
    assert (r.Actl_TP_Fcst, r.Delta, r.Actl_TP_Fcst_Delta, r.Shipments, r.Forecast) == (3, .5, 3.5, 5, 0)


def test_unknown_keys(spark):
    raw = rows(spark, dict(Actl_TP_Fcst=1.0), dict(Actl_TP_Fcst=4.0, SRP7=None))
    deltas = rows(
        spark, dict(Director=None, Sales_Manager="new", Delta=2.0), dict(Director=None, SRP7=None, Delta=8.0)
    )
    got = monthend.month_end_rework(raw, deltas)
    # raw rows with an unknown key go; deltas keep theirs, written as 0
    assert {(r.Director, r.SRP7, r.Actl_TP_Fcst_Delta) for r in got.collect()} == {
        ("boss", "7", 1), ("0", "7", 2), ("boss", "0", 8),
    }
    strict = monthend.month_end_rework(raw, deltas, fill_keys=False)
    assert {r.Actl_TP_Fcst_Delta for r in strict.collect()} == {1}
    kept = monthend.month_end_rework_r(raw, deltas)
    assert "Director" not in kept.columns
    assert {(r.SRP7, r.Actl_TP_Fcst_Delta) for r in kept.collect()} == {
        ("7", 1), (None, 4), ("7", 2), ("0", 8),
    }


def test_pooled_over_last_key(spark):
    raw = rows(
        spark, dict(Actl_TP_Fcst=1.0), dict(Actl_TP_Fcst=4.0, Current_Month="Y"),
        dict(Actl_TP_Fcst=9.0, Key="other"),
    )
    deltas = rows(spark, dict(Delta=2.0))
    got = monthend.month_end_rework_r(raw, deltas, pooled=True).collect()
    assert {(r.Key, r.Current_Month, r.Actl_TP_Fcst_Delta) for r in got} == {
        ("k", "N", 7), ("k", "Y", 7), ("other", "N", 9),
    }


def test_two_directors_are_an_error(spark):
    raw = rows(spark, dict(Actl_TP=1.0), dict(Actl_TP=1.0, Director="second"))
    deltas = rows(spark, dict(Delta=1.0))
    with pytest.raises(Exception, match="more than one director for m"):
        monthend.month_end_rework(raw, deltas).collect()


def published(spark, *items):
    raw = rows(spark, *[{k: v for k, v in x.items()} for x in items])
    return monthend.month_end_rework_r(raw, rows(spark))


def test_variance(spark):
    this = published(
        spark,
        *[dict(Customer=CODE, Sales_Manager=m, Actl_TP_Fcst=x) for m, x in (
            ("a", 5_050.0), ("b", 1_000.0), (None, 3_000.0), ("house", 9e9), ("ALL OTHER", 9e9))],
        dict(Customer="c", Sales_Manager="a", Actl_TP_Fcst=7e9),
        dict(Customer=CODE, Sales_Manager="a", Year=2019, Actl_TP_Fcst=7e9),
    )
    last = published(
        spark,
        *[dict(Customer=CODE, Sales_Manager=m, Actl_TP_Fcst=x) for m, x in (
            ("a", 6_000.0), ("gone", 500.0))],
    )
    got = monthend.variance_top_n(this, last, 2020, ["house"]).collect()
    # 5.05 is a tie and goes to the even 5.0; the unknown manager stays, written as 0
    assert [(r.Sales_Manager, r.TM_Total, r.LM_Total, r.color) for r in got] == [
        ("0", 3.0, 0.0, "above"), ("b", 1.0, 0.0, "above"), ("a", 5.0, 6.0, "below"),
    ]
    assert [r.abs_variance for r in got] == [3.0, 1.0, 1.0]
    full = monthend.variance_top_n(this, last, 2020, ["house"], how="full").collect()
    assert ("gone", 0.0, 0.5) in {(r.Sales_Manager, r.TM_Total, r.LM_Total) for r in full}
    assert len(monthend.variance_top_n(this, last, 2020, ["house"], n=2).collect()) == 2


def test_snapshot(spark):
    me = published(
        spark,
        dict(Customer=CODE, Sales_Manager="a", Actl_TP_Fcst=2.5),
        dict(Customer=CODE, Sales_Manager="ALL OTHER", Actl_TP_Fcst=3.5),
        dict(Customer=CODE, Sales_Manager=None, Actl_TP_Fcst=1.0),
        dict(Customer="c", Sales_Manager=None, Actl_TP_Fcst=1.0),
        dict(Actl_TP_Fcst=99.0, FC_Date=dt.date(2020, 1, 1), Month_No=1),
    )
    history = spark.createDataFrame(
        [("old", "d", "USA", "m", m, y, "BF", 1.0) for m, y in ((1, 2020), (2, 2020), (1, 2019))],
        layouts.SNAPSHOT,
    )
    out = monthend.forecast_snapshot(me, history)
    assert out.columns == history.columns
    got = out.collect()
    assert {(r.Customer, r.Sales_Manager, r.Forecast_Plus_Delta) for r in got
            if r.Forecast_Type == "LE"} == {
        ("ALL OTHER BY SALES MANAGER", "a", 2.0), (CODE, "ALL OTHER", 4.0), (None, None, 1.0),
        ("c", None, 1.0),
    }
    assert [(r.Month_No, r.Year) for r in got if r.Customer == "old"] == [(1, 2020)]
    ordered = [r.Customer for r in monthend.snapshot_export(out).collect()]
    assert ordered == sorted(ordered, key=lambda c: c or "")


def test_harmonise_and_metrics(spark):
    schema = (
        "Month string, `US/INT` string, `Promo/NPD?` string, Customer string, Category string,"
        "`Item Num/Desc` string, `Reason For Adjustment` string, `Forecast Units` double,"
        "`Forecast Cost $` double, `Order Units` double, `Order Cost $` double,"
        "`Forecast Unit Adjustment` double, `Forecast Units Corrected` double,"
        "`Order Unit Adjustment` double, `Order Units Corrected` double,"
    )
    def source(costs, *items):
        return spark.createDataFrame(
            [(m, "United States", promo, "Meijer x", "cat", "12 big knife", None, 1.0, 2.0, ou, 9.0,
              0.0, f, 0.0, o, fc, oc) for m, promo, ou, f, o, fc, oc in items],
            schema + ", ".join(f"`{c}` double" for c in costs),
        )
    this = source(
        ("Forecast Cost Corrected", "Order Cost Corrected"),
        ("2020/Jan", "No", 4.0, 6.0, 4.0, 0.5, 2.5),
        ("2020/Jan/x", "Yes", 4.0, 6.0, 4.0, 0.5, 2.5),
        ("2020", "No", 0.0, 5.0, 0.0, 1.0, 0.0),
    )
    last = source(
        ("Adjusted Forecast Cost", "Adjusted Order Cost"), ("2019/Feb", "No", 3.0, 0.0, 0.0, 0.0, 0.0)
    )
    both = harmonise.harmonise_accuracy(last, "last_year").unionByName(
        harmonise.harmonise_accuracy(this, "this_year")
    )
    out = harmonise.combine_units(harmonise.error_metrics(both))
    assert tuple(out.columns) == layouts.COMBINED_CARRIED + layouts.COMBINED_METRICS
    got = {r.MonthYear: r.asDict() for r in out.collect()}
    assert set(got) == {"January 2020", "NA 2020", "February 2019"}
    jan = got["January 2020"]
    assert (jan["SKU Number"], jan["Cost"], jan["Customer"]) == ("12", 2.25, "MEIJER")
    assert jan["Sales Rep Key"] == "USAMeijer xRECREATION"
    assert (jan["Adjusted FC - Cost"], jan["Adjusted Orders - Cost"]) == (0, 2)
    assert (jan["Error - Units"], jan["ABS Percent Error - Units"]) == (-2, 0.5)
    assert (jan["Accuracy - Units"], jan["Bias - Units"]) == (0.5, 0.5)
    assert (jan["Accuracy - Cost"], jan["Bias - Cost"]) == (0, -1)
    bad = got["NA 2020"]
    assert (bad["Cost"], bad["Accuracy - Units"], bad["ABS Percent Error - Units"]) == (None, 0, None)
    assert got["February 2019"]["Accuracy - Units"] is None

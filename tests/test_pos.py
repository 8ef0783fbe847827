import datetime as dt
import random

from pyspark.sql import functions as F

from demandmill.operators import hierarchy, pos, ranking
from demandmill.sources import layouts

ASOF = dt.date(2020, 10, 20)
VERSION = dt.date(2020, 4, 13)


def forecast(spark, rows):
    """rows: (version, ASIN, month number, mean)"""
    names = "January February March April May June July August September".split()
    return spark.createDataFrame(
        [(v, a, "u", "t", m, names[m - 1], 2020, x, x + 1, x + 2, x + 3) for v, a, m, x in rows],
        layouts.FORECAST_MONTHLY,
    )


def leads(spark, rows):
    return spark.createDataFrame(rows, layouts.LEADTIMES)


def shipped(spark, rows):
    return spark.createDataFrame(rows, "Date date, ASIN string, Shipped_Units double")


def test_lag_window_and_unknowns(spark):
    fc = forecast(
        spark,
        [(VERSION, "A", m, 10.0) for m in range(5, 10)]
        + [(dt.date(2020, 4, 16), "A", 5, 1.0), (dt.date(2020, 4, 8), "A", 5, 1.0)]
        + [(VERSION, "N", 5, 10.0)],
    )
    base = pos.pos_accuracy_base(
        fc,
        leads(spark, [("A", "SA", 2, "COOKING", "x")]),
        shipped(spark, [(dt.date(2020, 5, 1), "A", 12.0), (dt.date(2020, 6, 1), "A", 0.0)]),
        ASOF,
    )
    got = {(r.ASIN, r.Lag): r for r in base.collect()}
    # lag 5 is left out; versions on day 8 and 16 are not second-week versions
    assert sorted(got) == [("A", 1), ("A", 2), ("A", 3), ("A", 4), ("N", 1)]
    assert [got["A", n].Our_LT for n in (1, 2, 3, 4)] == [False, True, False, False]
    assert got["N", 1].Our_LT is None and got["N", 1].SKU is None
    assert (got["A", 1].Mean_ABS_Error, got["A", 1].P70_Below, got["A", 1].P80_Below) == (2, 0, 1)
    assert got["A", 3].Mean_ABS_Error is None and got["A", 3].P70_Below is None

    view = {(r.View, r.Month): r for r in pos.accuracy_by_view(base).collect()}
    # an item without shipments counts as a row but not in the error
    may = view["Lag_1", "May"]
    assert (may.Num_SKUs, may.Mean_ABS_Error, may.Shipped_Units) == (2, 2, 12)
    assert may.Mean_Acc == 1 - 2 / 12 and may.P80_Below == 0.5
    assert view["Lag_2", "June"].Mean_Acc is None
    assert view["Our_LT", "June"].Mean_ABS_Error == 10


def test_window_is_twelve_complete_months(spark):
    fc = forecast(spark, [(VERSION, "A", 5, 1.0)])
    empty = shipped(spark, [])
    table = leads(spark, [("A", "SA", 1, None, None)])
    assert pos.pos_accuracy_base(fc, table, empty, dt.date(2020, 6, 1)).count() == 1
    assert pos.pos_accuracy_base(fc, table, empty, dt.date(2020, 5, 31)).count() == 0
    assert pos.pos_accuracy_base(fc, table, empty, dt.date(2021, 5, 31)).count() == 1
    assert pos.pos_accuracy_base(fc, table, empty, dt.date(2021, 6, 1)).count() == 0


def test_lookup_copies(spark):
    """Every match gives a row; with ``dedupe`` equal rows count once."""
    fc = forecast(spark, [(VERSION, "A", 5, 1.0)] * 3)
    actual = shipped(spark, [(dt.date(2020, 5, 1), "A", 2.0)] * 4)
    table = leads(spark, [("A", "SA", 1, "c", "s")])
    seg = spark.createDataFrame([("SA", "Smooth", "A")] * 2, "ITEM_NUMBER string, DEMAND_CAT_CU string, ABC_REV_ITM_CU string")
    assert pos.pos_accuracy_base(fc, table, actual, ASOF).count() == 12
    assert pos.pos_accuracy_base(fc, table, actual, ASOF, seg, dedupe=True).count() == 1


def test_segments_of(spark):
    rows = [("c", "me", "S1", "Smooth", "A"), ("c", "other", "S1", "Lumpy", "C")]
    df = spark.createDataFrame(rows, layouts.SEGMENTS)
    assert [tuple(r) for r in pos.segments_of(df, "c", "me").collect()] == [("S1", "Smooth", "A")]


def test_division(spark):
    cells = ["WATERING", "COOKING", "other", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = df.orderBy("i").select(hierarchy.division_of("c").alias("d")).collect()
    assert [r.d for r in got] == ["WAT", "SOC", "GOL", None]


def top_by_hand(rows, n):
    out = []
    for k, v, i in rows:
        if v is not None and sum(1 for k2, v2, _ in rows if k2 == k and v2 is not None and v2 > v) < n:
            out.append((k, v, i))
    return sorted(out, key=repr)


def test_top_n_with_ties(spark):
    rng = random.Random(3)
    # one group holds most rows, most of them tied
    rows = [("hot", float(rng.choice([0, 0, 0, 0, 1, 2, 3])), i) for i in range(600)]
    rows += [(None, float(rng.randrange(9)), 1000 + i) for i in range(40)]
    rows += [("cold", None, 2000), ("cold", 5.0, 2001)]
    df = spark.createDataFrame(rows, "k string, v double, i int").repartition(5)
    for n in (1, 3, 50, 120, 1000):
        got = [tuple(r) for r in ranking.top_n_with_ties(df, ["k"], "v", n).collect()]
        assert sorted(got, key=repr) == top_by_hand(rows, n), n


def test_fifty_first_item_with_a_tie_is_kept(spark):
    rows = [("s", float(100 - i), i) for i in range(50)] + [("s", 51.0, 50), ("s", 1.0, 51)]
    df = spark.createDataFrame(rows, "k string, v double, i int")
    assert ranking.top_n_with_ties(df, ["k"], "v", 50).count() == 51


def test_representative_and_labels(spark):
    cols = (
        "Fcst_Date date, SKU string, Product_Title string, Category string, Sub_Category string, "
        "DEMAND_CAT_CU string, ABC_REV_ITM_CU string, Mean_Fcst double, Mean_ABS_Error double, "
        "Shipped_Units double, Our_LT boolean"
    )
    may, june = dt.date(2020, 5, 1), dt.date(2020, 6, 1)
    base = spark.createDataFrame(
        [
            (may, "S1", "one", "WATERING", "hose", "Smooth", "A", 9.0, 1.0, 10.0, True),
            (june, "S1", "one", "WATERING", "hose", "Smooth", "A", 8.0, 2.0, 10.0, True),
            (june, "S2", "two", None, "hose", "New", "Z", 8.0, 9.0, 4.0, True),
            (june, "S3", "three", None, "hose", "New", None, 8.0, 9.0, 400.0, True),
            (june, "S1", "one", "WATERING", "hose", "Smooth", "A", 8.0, 99.0, 999.0, False),
        ],
        cols,
    )
    got = {r.Product_Title: r for r in hierarchy.hierarchy_tree_rows(base).collect()}
    assert sorted(got) == ["one", "two"]
    # 1 - 3/20 for the division; 1 - 21/424 for the sub-category
    assert (got["one"].Div, got["one"].SKU) == ("WAT (85% )", "S1 (85% )")
    assert got["one"].Sub_Category == "hose (95.05% )"
    assert got["one"].Mean_Fcst == 8 and got["one"].abc_col == "red"
    assert got["two"].SKU == "S2 (0% )" and got["two"].abc_col == "yellow"
    assert got["two"].Category.startswith("NA (")


def test_items_without_a_lead_time_match_segments_without_an_item(spark):
    """NULL matches NULL, with and without such segments."""
    fc = spark.createDataFrame(
        [(dt.date(2020, 1, 13), x, x, x, 3, "March", 2020, 1.0, 1.0, 1.0, 1.0) for x in ("A", "B")],
        "POS_Fcst_Version_Date date, ASIN string, UPC string, Product_Title string, Month_Num int, "
        "Month string, Year int, Mean_Fcst double, P70_Fcst double, P80_Fcst double, P90_Fcst double",
    )
    lt = spark.createDataFrame([("A", "SA", 2, "C", "S")],
                               "ASIN string, SKU string, Our_LT int, Category string, Sub_Category string")
    act = spark.createDataFrame([(dt.date(2020, 3, 1), "A", 1.0)], "Date date, ASIN string, Shipped_Units double")
    kind = "ITEM_NUMBER string, DEMAND_CAT_CU string, ABC_REV_ITM_CU string"
    for extra, want in (([], [("A", "Smooth"), ("B", None)]),
                        ([(None, "New", "C"), (None, "Lumpy", "C")],
                         [("A", "Smooth"), ("B", "Lumpy"), ("B", "New")])):
        seg = spark.createDataFrame([("SA", "Smooth", "A"), *extra], kind)
        got = pos.pos_accuracy_base(fc, lt, act, dt.date(2020, 10, 15), seg, True).collect()
        assert sorted(((r.ASIN, r.DEMAND_CAT_CU) for r in got), key=repr) == sorted(want, key=repr)


def test_a_third_of_both_sides_without_an_item(spark):
    """Hot NULLs, counted and salted, give what matching row by row gives, copies included."""
    rng = random.Random(5)
    asins = [f"A{i}" for i in range(60)]
    fc = forecast(spark, [(VERSION, a, 5, 1.0) for a in asins])
    lead = [(a, None if i % 3 == 0 else f"S{i}", 1, "c", "s") for i, a in enumerate(asins[:50])]
    lead += lead[:9]
    seg = [(None, rng.choice("XY"), rng.choice(["A", None])) for _ in range(40)]
    seg += [(f"S{i}", "Z", "B") for i in range(0, 60, 2)]
    kind = "ITEM_NUMBER string, DEMAND_CAT_CU string, ABC_REV_ITM_CU string"
    ships = shipped(spark, [(dt.date(2020, 5, 1), a, 1.0) for a in asins])

    def plain(lead, seg):
        out = []
        for a in asins:
            skus = [x[1] for x in lead if x[0] == a] or [None]
            for sku in skus:
                out += [(a, sku, d, c) for n, d, c in seg if n == sku] or [(a, sku, None, None)]
        return out

    for dedupe in (False, True):
        got = pos.pos_accuracy_base(
            fc, leads(spark, lead), ships, ASOF, spark.createDataFrame(seg, kind), dedupe
        )
        text = got._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in text
        rows = [(r.ASIN, r.SKU, r.DEMAND_CAT_CU, r.ABC_REV_ITM_CU) for r in got.collect()]
        want = plain(set(lead), set(seg)) if dedupe else plain(lead, seg)
        assert sorted(rows, key=repr) == sorted(want, key=repr)


def test_forecast_rows_take_part_in_two_joins(spark, sf):
    from demandmill.plans import catalog

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = catalog.QUERIES["pos_base"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spine = text[: text.index("l_quantity")] if "l_quantity" in text else text
    assert "NestedLoop" not in text and spine.count("SortMergeJoin") <= 3

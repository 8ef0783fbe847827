"""Physical plans of every query, and of the operators on stored tables."""

import re

import pytest
from pyspark.sql import functions as F

from demandmill.operators import backtest, models, pos, reports, scoring, series, weekly
from demandmill.plans import inputs
from demandmill.plans.catalog import QUERIES
from demandmill.sources import layouts

# These write their tables when called.
EAGER = {n for n in QUERIES if n.startswith(("ingest_", "published_"))} | {
    "write_read_roundtrip", "snapshot_rewritten", "append_new_partitions",
    "pos_kpis_merged", "pos_trend_merged", "pos_by_segment_merged",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(text):
    """What ran: without the plans from before execution, of subqueries too."""
    out, skip = [], None
    for line in re.split(r"^\+- == Initial Plan ==", text, flags=re.M)[0].splitlines():
        start = len(line) - len(line.lstrip(" :+-*|"))
        if "== Initial Plan ==" in line:
            skip = line.index("==")
        elif skip is None or start < skip:
            skip = None
            out.append(line)
    return "\n".join(out)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in EAGER])
def test_no_pairing_of_all_rows(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    # Only the Python models leave the JVM.
    python = "MapInPandas" in text or "ArrowEval" in text or "BatchEval" in text
    assert python == (name in ("backtest_python", "backtest_failing_models", "model_forecasts"))


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    """Planning tables as Parquet, the way they are kept."""
    root = tmp_path_factory.mktemp("stored")
    tables = {
        "fc": inputs.forecast_monthly(spark, sf), "lt": inputs.leadtimes(spark, sf),
        "act": inputs.actuals(spark, sf), "weekly": inputs.weekly_raw(spark, sf),
        "wide": inputs.history_wide(spark, sf),
    }
    out = {}
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}")
        out[name] = spark.read.parquet(f"{root}/{name}")
    return out


def base(stored):
    return pos.pos_accuracy_base(stored["fc"], stored["lt"], stored["act"], inputs.ASOF)


def test_filters_and_columns_reach_the_scan(stored, capsys):
    pos.accuracy_by_view(base(stored)).explain("formatted")
    text = capsys.readouterr().out
    scans = [x for x in text.split("\n\n") if "ReadSchema" in x]
    assert len(scans) == 3
    forecast = next(x for x in scans if "Mean_Fcst" in x)
    assert "GreaterThanOrEqual(Year,2000)" in forecast and "Product_Title" not in forecast
    actual = next(x for x in scans if "Shipped_Units" in x)
    assert "GreaterThanOrEqual(Date,2000-10-01)" in actual


def test_small_lookups_are_broadcast_and_views_share_one_pass(stored):
    text = plan(pos.accuracy_by_view(base(stored)))
    assert text.count("BroadcastHashJoin") == 2
    # rows are summed once; the copies per view are made of those sums
    assert text.count("Exchange hashpartitioning") == 2
    assert text.index("explode") < text.index("partial_count(1)")


def test_lookups_over_the_limit_are_not_broadcast(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(base(stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text and text.count("SortMergeJoin") == 2


def test_cleaning_has_no_shuffle(stored):
    text = plan(reports.clean_inventory(stored["weekly"], F.col("File_Date")))
    assert "Exchange" not in text and "Forecast" not in re.search(r"ReadSchema.*", text).group()


def test_weekly_has_one_shuffle(stored):
    text = plan(weekly.weekly_to_monthly(stored["weekly"], F.col("File_Date")))
    assert text.count("Exchange") == 1 and text.count("Generate") == 1
    assert "Expand" not in text


def test_tree_computes_its_rows_once(spark, sf):
    df = QUERIES["hierarchy_tree"](spark, sf)
    df.collect()
    final = final_plan(plan(df))
    # forecasts, lead times, actuals and segments: read once, though labels, ranking and
    # representatives all start from them
    assert final.count("FileScan") == 4 and "ReusedExchange" in final


def test_scores_share_checkpointed_rows(spark, sf):
    test = spark.createDataFrame([("A", "m", "Jan_2020", 1.0), ("Z", "m", "Jan_2020", 1.0)],
                                 "SKU string, Model string, Month string, Forecast double")
    acc = test.where("SKU = 'A'").selectExpr(
        "SKU", "'Jan_2020' Month_Year", "1D Cost", "1D Adj_FC_Units", "1D Adj_FC_Cost",
        "2D Adj_Orders_Units", "2D Adj_Orders_Cost", "1D Stat_FC_Units", "1D Stat_FC_Cost",
    )
    scores = scoring.score(test, acc, ["m"], ["Jan_2020"])
    for df in scores[1:3]:
        assert "Scan ExistingRDD" in plan(df) and "Join" not in plan(df)
    assert scores.sku_details.count() == 3 and scores.excluded_skus.first().SKU == "Z"
    assert scores.sku_summary.first().Best_Model == "Sales_Acc_Cost"
    assert {r.Model for r in scores.model_summary.collect()} == {
        "Sales_Forecast", "Stat_Forecast", "m_Test_Set",
    }


def test_backtest_shuffles_once(stored):
    df = backtest.test_set_forecasts(series.history_series(stored["wide"]), models.NATIVE_MODELS)
    text = plan(df)
    assert text.count("Exchange") == 1 and "Window" not in text and "Sort " not in text


def test_running_models_pass_once_over_a_series_for_any_number_of_origins(stored):
    wide = series.history_series(stored["wide"])
    folds = [
        plan(backtest.test_set_forecasts(wide, models.RUNNING_MODELS, months)).count("aggregate(slice(")
        for months in (1, 24)
    ]
    assert folds[0] == folds[1]

"""Registered queries: every capability over the derived tables.

Each entry takes the session and a table directory. Dates are shown as ISO text so that results
compare equal across engines.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandmill.functions import dates, text
from demandmill.functions.rules import exact_total, half_even, strict_sum
from demandmill.operators import (
    backtest,
    harmonise,
    hierarchy,
    models,
    monthend,
    pos,
    pos_totals,
    ranking,
    reports,
    scoring,
    series,
    weekly,
)
from demandmill.plans import files, inputs
from demandmill.session import shared_dir
from demandmill.sources import layouts, readers, sinks

Query = Callable[[SparkSession, str], DataFrame]

MODELS = list(models.NATIVE_MODELS)
TEST_MONTHS, LEAD_TIME, HORIZON = 3, 3, 6
MANY_MONTHS = 24
SCORED = ("CUST N", ["GOL", "SOC"], "USA")
TEST_LABELS = [dates.label_of(m) for m in inputs.MONTHS[-TEST_MONTHS:]]


def shown(df: DataFrame) -> DataFrame:
    casts = {T.DateType: "string", T.DecimalType: "double"}
    out = {
        f.name: F.col(f"`{f.name}`").cast(casts[type(f.dataType)])
        for f in df.schema.fields
        if type(f.dataType) in casts
    }
    return df.withColumns(out) if out else df


# ---- forecast accuracy --------------------------------------------------------------------------


def _base(spark: SparkSession, sf: str, dedupe: bool = True) -> DataFrame:
    return _based_on(spark, sf, inputs.forecast_monthly(spark, sf), inputs.segments(spark, sf), dedupe)


def _based_on(
    spark: SparkSession, sf: str, forecasts: DataFrame, segments: DataFrame, dedupe: bool = True
) -> DataFrame:
    seg = pos.segments_of(segments, inputs.COMPANY, inputs.CUSTOMER)
    return pos.pos_accuracy_base(
        forecasts,
        inputs.leadtimes(spark, sf),
        inputs.actuals(spark, sf),
        inputs.ASOF,
        seg,
        dedupe,
    )


def _segments_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy by segment from a stored sheet of segments and a saved table of forecasts."""
    root = f"{shared_dir(spark)}/sheets-{uuid.uuid4().hex}"
    sinks.write_csv(inputs.segments(spark, sf), f"{root}/segments")
    inputs.forecast_monthly(spark, sf).write.parquet(f"{root}/forecasts")
    base = _based_on(
        spark, sf,
        readers.read_table(spark, f"{root}/forecasts", layouts.FORECAST_MONTHLY),
        readers.read_typed_csv(spark, f"{root}/segments", layouts.SEGMENTS),
    )
    return pos.accuracy_by_segment(base)


def _stored_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Totals stored two months ago without the last version month, then brought up to date."""
    root = f"{shared_dir(spark)}/totals-{uuid.uuid4().hex}"
    last = dates.add_months(inputs.ASOF, -2)
    version = F.col("POS_Fcst_Version_Date")
    sinks.write_partitions(
        inputs.forecast_monthly(spark, sf), f"{root}/forecasts", ["POS_Fcst_Version_Date"]
    )
    forecasts = readers.read_table(spark, f"{root}/forecasts", layouts.FORECAST_MONTHLY)
    lookups = inputs.leadtimes(spark, sf), inputs.actuals(spark, sf)
    seg = pos.segments_of(inputs.segments(spark, sf), inputs.COMPANY, inputs.CUSTOMER)
    earlier = forecasts.where((version < F.lit(last)) | (version >= F.lit(dates.add_months(last, 1))))
    pos_totals.refresh(spark, f"{root}/totals", earlier, *lookups, last, seg, dedupe=True)
    pos_totals.refresh(
        spark, f"{root}/totals", forecasts, *lookups, inputs.ASOF, seg, versions=[last], dedupe=True
    )
    return pos_totals.read_totals(spark, f"{root}/totals")


def _by_view(spark: SparkSession, sf: str) -> DataFrame:
    """The plain script's form: no segments, every lookup match counts."""
    base = pos.pos_accuracy_base(
        inputs.forecast_monthly(spark, sf),
        inputs.leadtimes(spark, sf),
        inputs.actuals(spark, sf),
        inputs.ASOF,
    )
    return pos.accuracy_by_view(base)


def _units_by_brand(spark: SparkSession, sf: str) -> DataFrame:
    units = inputs.table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("units")
    )
    part = inputs.table(spark, sf, "part").select("p_partkey", "p_brand")
    items = part.join(units, F.col("p_partkey") == F.col("l_partkey"), "left")
    return ranking.top_n_with_ties(items, ["p_brand"], "units", 10).select(
        "p_brand", "p_partkey", "units"
    )


# ---- cleaning -----------------------------------------------------------------------------------


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    """Every text rule on one text per order."""
    price = F.col("o_totalprice").cast(inputs.MONEY)
    plain = F.format_number(price, 2)
    amount = F.concat(F.lit("$"), plain)
    share = F.concat(F.format_number(F.floor("o_totalprice") / 2, 1), F.lit("%"))
    raw = inputs.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("—"))
        .when(F.col("o_orderstatus") == "P", F.concat(F.lit("("), amount, F.lit(")")))
        .otherwise(amount)
        .alias("money"),
        share.alias("share"),
        plain.alias("count"),
    )
    return raw.select(
        "o_orderkey",
        text.money("money").alias("money"),
        text.money("money", paren_negative=True).alias("signed_money"),
        text.percent_text("share").alias("percent"),
        text.plain_percent_text("share").alias("plain_percent"),
        text.count_text("count").alias("count"),
    )


def _report(layout: layouts.Layout) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return shown(reports.clean_report(inputs.raw_report(spark, sf, layout), layout))

    return query


def _file_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Dates out of a monthly and a weekly file name per order; pending orders have none."""
    day = F.col("o_orderdate")
    pending = F.col("o_orderstatus") == "P"
    named = inputs.table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(
            F.lit("/drop/Raw/Report With UPC_"),
            F.when(pending, F.lit("Sometime")).otherwise(F.date_format(day, "MMMM")),
            F.date_format(day, "_yyyy"),
            F.lit(".csv"),
        ).alias("monthly"),
        F.concat(
            F.lit("/drop/Raw/Weekly Planning_"),
            F.when(pending, F.lit("13_")).otherwise(F.date_format(day, "MM_")),
            F.date_format(day, "dd_yyyy"),
            F.lit(".csv"),
        ).alias("weekly"),
    )
    monthly = [c.alias(n) for n, c in readers.month_columns("monthly").items()]
    return named.select("o_orderkey", *monthly, readers.date_in_name("weekly").alias("Week_Date"))


def _weekly(spark: SparkSession, sf: str) -> DataFrame:
    return weekly.weekly_to_monthly(inputs.weekly_raw(spark, sf), F.col("File_Date"))


def _strict(spark: SparkSession, sf: str) -> DataFrame:
    """Units per item and year, unknown once a line of the year was sent back untaxed."""
    units = F.when(
        ~((F.col("l_returnflag") == "R") & (F.col("l_tax") == 0)), F.col("l_quantity")
    )
    return (
        inputs.table(spark, sf, "lineitem")
        .groupBy("l_partkey", F.year("l_shipdate").alias("ship_year"))
        .agg(strict_sum(units).alias("units"))
    )


def _measures(spark: SparkSession, sf: str) -> DataFrame:
    """The forecasts as one long table, spread to a column per measure again."""
    return weekly.combine_forecast_measures([weekly.forecasts_long(_weekly(spark, sf))])


def _append_halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders known already, and orders of a load that repeats a year of them."""
    orders = inputs.table(spark, sf, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("date")
    )
    known = orders.where(F.col("o_orderdate") < F.lit(dt.date(1999, 1, 1)))
    return known, orders.where(F.col("o_orderdate") >= F.lit(dt.date(1998, 1, 1)))


def _append(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.append_unique(*_append_halves(spark, sf))


def _append_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The same on a stored table, a partition per quarter; the load is compared with its own alone."""
    path = f"{shared_dir(spark)}/append-{uuid.uuid4().hex}"
    halves = _append_halves(spark, sf)
    for rows in halves:
        sinks.append_new(spark, path, rows.withColumn("quarter", F.date_format("o_orderdate", "yyyy-'Q'Q")), ["quarter"])
    return sinks.read_appended(spark, path, halves[0].schema)


# ---- month end ----------------------------------------------------------------------------------


def _month_end(spark: SparkSession, sf: str, version: dt.date = inputs.THIS_VERSION) -> DataFrame:
    raw = inputs.at_version(inputs.month_end_raw(spark, sf), version)
    deltas = inputs.at_version(inputs.month_end_deltas(spark, sf), version)
    return monthend.month_end_rework(raw, deltas, version=version)


def _month_end_r(spark: SparkSession, sf: str, pooled: bool = False) -> DataFrame:
    return monthend.month_end_rework_r(
        inputs.month_end_raw(spark, sf), inputs.month_end_deltas(spark, sf), pooled,
        version=inputs.THIS_VERSION,
    )


def _variance(spark: SparkSession, sf: str) -> DataFrame:
    return monthend.variance_top_n(
        _month_end_r(spark, sf),
        _month_end(spark, sf, inputs.LAST_VERSION),
        inputs.THIS_VERSION.year,
        inputs.EXCLUDED_MANAGERS,
    )


class OutputBroken(Exception):
    """A run that ends between two outputs."""


def _publish(spark: SparkSession, sf: str, root: str, version: dt.date, breaks: bool = False) -> None:
    raw, deltas = inputs.month_end_raw(spark, sf), inputs.month_end_deltas(spark, sf)

    def rework(written: DataFrame) -> DataFrame:
        if breaks:
            raise OutputBroken
        return monthend.rework_with(raw, written, version)

    ready = monthend.month_end_deltas(raw, deltas, version=version)
    sinks.publish_month_end(ready, rework, root, version)


def _published(spark: SparkSession, sf: str) -> str:
    """Folder with month ends of two versions published one after the other."""
    root = f"{shared_dir(spark)}/month-end-{uuid.uuid4().hex}"
    for version in (inputs.LAST_VERSION, inputs.THIS_VERSION):
        _publish(spark, sf, root, version)
    return root


def _published_types(*without: str) -> T.StructType:
    fields = {f.name: f for f in layouts.MONTH_END.fields}
    names = [c for c in monthend.PUBLISHED if c not in without]
    return T.StructType([fields.get(c, T.StructField(c, T.DoubleType())) for c in names])


def _roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Publish the month end, then read the exported current table back."""
    path = sinks.published_path(spark, _published(spark, sf), "current_csv")
    return readers.read_typed_csv(spark, path, _published_types(), "MM/dd/yyyy")


def _output_sums(spark: SparkSession, root: str, version: dt.date) -> DataFrame:
    """All five published outputs read back: rows and sums of each."""
    export = lambda name, *without: readers.read_typed_csv(
        spark, sinks.published_path(spark, root, name), _published_types(*without), "MM/dd/yyyy"
    )
    tables = {
        "deltas": sinks.published_month(spark, root, version, "deltas"),
        "monthly": sinks.published_month(spark, root, version),
        "current": export("current_csv"),
        "last_month": export("last_month_csv", monthend.COMBINED),
        "previous": export("previous_month_csv"),
    }
    counted = [
        df.agg(
            F.count(F.lit(1)).alias("n"), F.max(monthend.VERSION).alias("version"),
            *[half_even(exact_total(m), 2).alias(m) for m in ("Shipments", "Forecast", "Delta")],
        ).select(F.lit(name).alias("output"), "*")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def _outputs(spark: SparkSession, sf: str) -> DataFrame:
    return _output_sums(spark, _published(spark, sf), inputs.THIS_VERSION)


def _broken(spark: SparkSession, sf: str) -> DataFrame:
    """One version is published; the run of the next breaks after its first output: the old one is whole."""
    root = f"{shared_dir(spark)}/month-end-{uuid.uuid4().hex}"
    _publish(spark, sf, root, inputs.LAST_VERSION)
    try:
        _publish(spark, sf, root, inputs.THIS_VERSION, breaks=True)
    except OutputBroken:
        sinks.drop_unnamed(spark, root)
    return _output_sums(spark, root, inputs.LAST_VERSION)


def _snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return monthend.forecast_snapshot(
        _month_end(spark, sf), inputs.snapshot_history(spark, sf), inputs.THIS_VERSION
    )


def _snapshot_rewritten(spark: SparkSession, sf: str) -> DataFrame:
    """The stored snapshot history read, extended by this month's, and switched to."""
    root = f"{shared_dir(spark)}/snapshot-{uuid.uuid4().hex}"
    current = _month_end(spark, sf)
    sinks.rewrite(spark, root, lambda _: inputs.snapshot_history(spark, sf))
    sinks.rewrite(
        spark, root, lambda old: monthend.forecast_snapshot(current, old, inputs.THIS_VERSION)
    )
    return monthend.snapshot_export(sinks.read_current(spark, root, layouts.SNAPSHOT))


def _previous_month(spark: SparkSession, sf: str) -> DataFrame:
    """Order value of every month beside the month before it, with both export names."""
    monthly = (
        inputs.table(spark, sf, "orders")
        .groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
        .agg(F.sum(F.col("o_totalprice").cast(inputs.MONEY)).cast("double").alias("value"))
    )
    before = monthly.select(
        F.add_months("month", 1).alias("month"), F.col("value").alias("last_value")
    )
    last = F.last_day("month")
    return monthly.join(before, "month", "left").select(
        "month", "value", "last_value",
        sinks.export_name(last).alias("name"),
        sinks.export_name(F.last_day(F.add_months("month", -1))).alias("last_name"),
    )


# ---- combined accuracy --------------------------------------------------------------------------


def _harmonised(spark: SparkSession, sf: str) -> DataFrame:
    years = [
        harmonise.harmonise_accuracy(inputs.accuracy_source(spark, sf, x), x)
        for x in ("last_year", "this_year")
    ]
    return years[0].unionByName(years[1])


def _combined(spark: SparkSession, sf: str) -> DataFrame:
    return _by_customer(harmonise.error_metrics(_harmonised(spark, sf)))


def _combined_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The combined table written as a sheet and read by its declared columns."""
    path = f"{shared_dir(spark)}/combined-{uuid.uuid4().hex}"
    sinks.write_csv(harmonise.error_metrics(_harmonised(spark, sf)), path)
    return _by_customer(readers.read_typed_csv(spark, path, layouts.COMBINED))


def _by_customer(metrics: DataFrame) -> DataFrame:
    """Both years with metrics, and customers counted under one name."""
    table = harmonise.combine_units(metrics)
    return table.groupBy("Customer", "Year").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("Adjusted Orders - Units").alias("units"),
        F.sum("ABS Error - Units").alias("abs_error_units"),
    )


# ---- history, backtest, scoring -----------------------------------------------------------------


def _series(spark: SparkSession, sf: str) -> DataFrame:
    return series.history_series(inputs.history_wide(spark, sf))


def _series_shown(spark: SparkSession, sf: str) -> DataFrame:
    """The nested series, one row per point with its position."""
    return _series(spark, sf).select("SKU", F.posexplode(series.SERIES).alias("pos", "p")).select(
        "SKU", "pos", F.col("p.Date").alias("Date"), F.col("p.History").alias("History")
    )


def _test_set(spark: SparkSession, sf: str, names: list[str] = MODELS) -> DataFrame:
    return backtest.test_set_forecasts(
        _series(spark, sf), {n: models.NATIVE_MODELS[n] for n in names}, TEST_MONTHS, LEAD_TIME
    )


def _backtest(name: str) -> Query:
    return lambda spark, sf: shown(_test_set(spark, sf, [name]))


def _running(spark: SparkSession, sf: str) -> DataFrame:
    """Models of a running state from the origins of two years."""
    return backtest.test_set_forecasts(
        _series(spark, sf), models.RUNNING_MODELS, MANY_MONTHS, LEAD_TIME
    )


def _forecasts(spark: SparkSession, sf: str) -> DataFrame:
    return backtest.model_forecasts(_series(spark, sf), models.PYTHON_MODELS, HORIZON)


def _native_forecasts(spark: SparkSession, sf: str, names: list[str] = MODELS) -> DataFrame:
    chosen = {n: models.NATIVE_MODELS[n] for n in names}
    return backtest.model_forecasts_native(_series(spark, sf), chosen, HORIZON)


def _backtest_python(spark: SparkSession, sf: str) -> DataFrame:
    return backtest.test_set_forecasts_python(
        _series(spark, sf), models.PYTHON_MODELS, TEST_MONTHS, LEAD_TIME
    )


def _partial(spark: SparkSession, sf: str) -> DataFrame:
    """Models that fail on some items: their other forecasts, and the messages."""
    return backtest.test_set_forecasts_python(
        _series(spark, sf), models.PARTIAL_MODELS, TEST_MONTHS, LEAD_TIME, errors=True
    )


def _accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.accuracy_data(
        inputs.accuracy_report(spark, sf), inputs.stat_report(spark, sf), *SCORED
    )


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.scoring_rows(_test_set(spark, sf), _accuracy(spark, sf))


def _sums(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.scored_sums(_test_set(spark, sf), _accuracy(spark, sf))


def _scoring_run(spark: SparkSession, sf: str) -> DataFrame:
    """A whole scoring run from one call: what each of its four results holds."""
    scores = scoring.score(_test_set(spark, sf), _accuracy(spark, sf), MODELS, TEST_LABELS)
    rows = F.aggregate("Detail", F.lit(0).cast("bigint"), lambda acc, d: acc + d["Copies"])
    none = F.lit(None).cast("double")
    parts = [
        scores.sku_details.groupBy(F.col("Model").alias("name")).agg(
            F.sum(rows).alias("n")
        ).select(F.lit("detail").alias("result"), "name", "n", none.alias("acc")),
        scores.model_summary.groupBy(F.col("Model").alias("name")).agg(
            F.count(F.lit(1)).alias("n"), F.max("Total_Acc_Cost").alias("acc")
        ).select(F.lit("summary").alias("result"), "name", "n", "acc"),
        scores.sku_summary.groupBy(F.col("Best_Model").alias("name")).agg(
            F.count(F.lit(1)).alias("n")
        ).select(F.lit("best").alias("result"), "name", "n", none.alias("acc")),
        scores.excluded_skus.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("excluded").alias("result"), F.lit("all").alias("name"), "n", none.alias("acc")
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def _detail(spark: SparkSession, sf: str) -> DataFrame:
    """Nested detail, shown by what its arrays hold."""
    cost = F.aggregate(
        F.filter("Detail", lambda d: d["ABS_Error_Cost"].isNotNull()),
        F.lit(0.0),
        lambda acc, d: acc + d["ABS_Error_Cost"] * d["Copies"],
    )
    rows = F.aggregate("Detail", F.lit(0).cast("bigint"), lambda acc, d: acc + d["Copies"])
    return scoring.sku_detail_nested(_scored(spark, sf)).select(
        *scoring.DETAIL_KEYS, rows.alias("n_rows"), cost.alias("abs_error_cost")
    )


QUERIES: dict[str, Query] = {
    "pos_accuracy_by_view": lambda s, d: shown(_by_view(s, d)),
    "pos_base": lambda s, d: shown(_base(s, d)),
    "pos_kpis": lambda s, d: pos.kpi_totals(_base(s, d)),
    "pos_trend_long": lambda s, d: shown(
        pos.accuracy_trend_long(pos.accuracy_by_view(_base(s, d)))
    ),
    "pos_by_segment": lambda s, d: pos.accuracy_by_segment(_base(s, d)),
    "pos_by_segment_stored": _segments_stored,
    "pos_kpis_merged": lambda s, d: pos.kpi_totals(_stored_totals(s, d)),
    "pos_trend_merged": lambda s, d: shown(
        pos.accuracy_trend_long(pos.accuracy_by_view(_stored_totals(s, d)))
    ),
    "pos_by_segment_merged": lambda s, d: pos.accuracy_by_segment(_stored_totals(s, d)),
    "hierarchy_accuracy": lambda s, d: hierarchy.hierarchy_accuracy(_base(s, d)),
    "hierarchy_tree": lambda s, d: hierarchy.hierarchy_tree_rows(_base(s, d)),
    "top_n_with_ties": _units_by_brand,
    "clean_money_percent": _cells,
    **{f"clean_report_{n}": _report(x) for n, x in layouts.MONTHLY_LAYOUTS.items()},
    "clean_inventory": lambda s, d: shown(
        reports.clean_inventory(inputs.weekly_raw(s, d), F.col("File_Date"))
    ),
    "file_metadata": lambda s, d: shown(_file_metadata(s, d)),
    "weekly_to_monthly": lambda s, d: shown(weekly.forecasts_long(_weekly(s, d))),
    "strict_sum": _strict,
    "ingest_reports_two_runs": lambda s, d: shown(files.reports_in_two_runs(s, d)),
    "ingest_late_and_changed": lambda s, d: shown(files.late_and_changed(s, d)),
    "ingest_weekly_day_by_day": lambda s, d: shown(files.weekly_day_by_day(s, d)),
    "ingest_weekly_backlog": lambda s, d: shown(files.weekly_backlog(s, d)),
    "forecast_measures_wide": lambda s, d: shown(_measures(s, d)),
    "append_unique": lambda s, d: shown(_append(s, d)),
    "append_new_partitions": lambda s, d: shown(_append_stored(s, d)),
    "write_read_roundtrip": lambda s, d: shown(_roundtrip(s, d)),
    "published_outputs": lambda s, d: shown(_outputs(s, d)),
    "published_after_break": lambda s, d: shown(_broken(s, d)),
    "snapshot_export": lambda s, d: monthend.snapshot_export(_snapshot(s, d)),
    "snapshot_rewritten": _snapshot_rewritten,
    "previous_month_partition": lambda s, d: shown(_previous_month(s, d)),
    "month_end_rework": lambda s, d: shown(_month_end(s, d)),
    "month_end_rework_r": lambda s, d: shown(_month_end_r(s, d)),
    "month_end_rework_r_pooled": lambda s, d: shown(_month_end_r(s, d, pooled=True)),
    "month_over_month_top10": _variance,
    "forecast_snapshot": _snapshot,
    "harmonise_accuracy": _harmonised,
    "error_metrics": lambda s, d: harmonise.error_metrics(_harmonised(s, d)),
    "canonical_customer": _combined,
    "canonical_customer_stored": _combined_stored,
    "history_long": lambda s, d: shown(series.history_long(inputs.history_wide(s, d))),
    "history_complete": lambda s, d: shown(series.complete_calendar(inputs.history_sparse(s, d))),
    "history_series": lambda s, d: shown(_series_shown(s, d)),
    **{f"backtest_{n}": _backtest(n) for n in models.NATIVE_MODELS},
    "backtest_running": lambda s, d: shown(_running(s, d)),
    "backtest_python": lambda s, d: shown(_backtest_python(s, d)),
    "backtest_failing_models": lambda s, d: shown(_partial(s, d)),
    "model_forecasts": lambda s, d: shown(_forecasts(s, d)),
    "model_forecasts_native": lambda s, d: shown(_native_forecasts(s, d)),
    "accuracy_base": _accuracy,
    "scoring_rows": _scored,
    "scoring_sku_totals": lambda s, d: scoring.sku_totals(_sums(s, d)),
    "scoring_model_summary": lambda s, d: scoring.model_summary(_sums(s, d), TEST_LABELS),
    "best_model_per_sku": lambda s, d: scoring.best_model_per_sku(
        scoring.sku_totals(_sums(s, d)), MODELS
    ),
    "scoring_run": _scoring_run,
    "excluded_skus": lambda s, d: scoring.excluded_skus(_test_set(s, d), _accuracy(s, d)),
    "sku_detail_nested": _detail,
    "forecast_export_wide": lambda s, d: backtest.forecast_export(
        _native_forecasts(s, d, ["moving_avg"]), "moving_avg", inputs.LAST_MONTH, HORIZON
    ),
}

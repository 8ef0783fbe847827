"""Forecast accuracy by lag and own lead time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandmill.functions.dates import month_lag, month_short, trailing_year
from demandmill.functions.rules import (
    accuracy,
    exact_sum,
    exact_total,
    if_known,
    match_join,
    percent,
    ratio,
)

# File days that count as a month's second week, and the lag left out.
SECOND_WEEK = (9, 15)
SKIPPED_LAG = 5
LAGS = (1, 2, 3)
QUANTILES = ("P70", "P80", "P90")

# Order of segment classes on a report, and classes not reported.
SEGMENT_ORDER = ("A", "B", "C", "Smooth", "Erratic", "Intermittent", "Lumpy")
UNREPORTED_DEMAND = ("New", "Inactive")

#: Partitions that rows without an item are spread over.
SALTS = 64

#: What is added up for accuracy.
SUMS = ["Mean_Fcst", "Mean_ABS_Error", "Shipped_Units", *[f"{q}_Below" for q in QUANTILES]]

TREND_TYPES = ("Mean_Acc", "P70_Below", "P80_Below", "P90_Below")


def segments_of(segments: DataFrame, company: str, customer: str) -> DataFrame:
    """Demand category and value class of one company's items at one customer."""
    return segments.where(
        (F.col("COMPANY") == company) & (F.col("CUSTOMER") == customer)
    ).select("ITEM_NUMBER", "DEMAND_CAT_CU", "ABC_REV_ITM_CU")


def with_lag(forecasts: DataFrame, asof: dt.date) -> DataFrame:
    """Second-week versions of the twelve complete months before ``asof``, with their lag."""
    first, last = trailing_year(asof)
    return (
        # The year bounds repeat the date filter in a form the Parquet reader can use.
        forecasts.where(F.col("Year").between(first.year, last.year))
        .where(F.dayofmonth("POS_Fcst_Version_Date").between(*SECOND_WEEK))
        .withColumn("Fcst_Date", F.make_date("Year", "Month_Num", F.lit(1)))
        .where(F.col("Fcst_Date").between(F.lit(first), F.lit(last)))
        .withColumn("Lag", month_lag("POS_Fcst_Version_Date", "Fcst_Date"))
        .where(F.col("Lag") != SKIPPED_LAG)
    )


def pos_accuracy_base(
    forecasts: DataFrame,
    leadtimes: DataFrame,
    actuals: DataFrame,
    asof: dt.date,
    segments: DataFrame | None = None,
    dedupe: bool = False,
) -> DataFrame:
    """Forecast rows with lag, lead-time flag, shipped units and row errors.

    With ``dedupe`` (the dashboard's form) equal rows count once; the lookups are made distinct
    before they are joined, so copies cannot multiply each other. Without it every match of a
    lookup gives a row. Lookups carry no broadcast hint (see ``match_join``). Segments are joined to
    the lead times, item by item, so the forecast rows take part in two joins.
    """
    first, last = trailing_year(asof)
    shipped = actuals.where(F.col("Date").between(F.lit(first), F.lit(last))).select(
        "Date", "ASIN", "Shipped_Units"
    )
    if dedupe:
        leadtimes, shipped = leadtimes.distinct(), shipped.distinct()
        segments = segments.distinct() if segments is not None else None
    rows = with_lag(forecasts, asof)
    shared = [c for c in leadtimes.columns if c in rows.columns]
    items = leadtimes
    if segments is not None:
        named = segments.where(F.col("ITEM_NUMBER").isNotNull())
        items = leadtimes.join(named, F.col("SKU") == F.col("ITEM_NUMBER"), "left").drop("ITEM_NUMBER")
    rows = match_join(rows, items, [(c, c) for c in shared])
    rows = rows.withColumn("Our_LT", if_known(F.col("Lag") == F.col("Our_LT"), F.lit(True), F.lit(False)))
    rows = match_join(rows, shipped, [("Fcst_Date", "Date"), ("ASIN", "ASIN")])
    if segments is not None:
        rows = _segments_without_item(rows, segments)
    metrics: dict[str, Column] = {
        "Mean_ABS_Error": F.abs(F.col("Mean_Fcst") - F.col("Shipped_Units"))
    }
    for q in QUANTILES:
        metrics[f"{q}_Below"] = if_known(
            F.col(f"{q}_Fcst") >= F.col("Shipped_Units"), F.lit(1), F.lit(0)
        )
    lead = ["Fcst_Date", "ASIN", "UPC", "SKU", "Product_Title", "Category", "Sub_Category"]
    tail = [
        "Month_Num", "Month", "Year", "Mean_Fcst", "P70_Fcst", "P80_Fcst", "P90_Fcst", "Lag",
        "Our_LT", "Shipped_Units", "DEMAND_CAT_CU", "ABC_REV_ITM_CU",
    ]
    rows = rows.select(
        *[c for c in lead + tail if c in rows.columns],
        *[c.alias(n) for n, c in metrics.items()],
    )
    return rows.distinct() if dedupe else rows


def _segments_without_item(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """Rows without a SKU (or without a lead time) match the segments that have no item.

    Such segments are counted per pair of classes first, so a hot NULL is a few rows with counts, given
    once per salt. Rows are spread over the salts, those with a SKU over salts that match nothing: NULL
    would put them all into one partition. Copies come back by count after the join.
    """
    names = ["DEMAND_CAT_CU", "ABC_REV_ITM_CU"]
    pairs = (
        segments.where(F.col("ITEM_NUMBER").isNull())
        .groupBy(*[F.col(n).alias(f"__{n}") for n in names])
        .agg(F.count(F.lit(1)).alias("__copies"))
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    spread = F.pmod(F.xxhash64("ASIN", "Fcst_Date", "POS_Fcst_Version_Date"), F.lit(SALTS)).cast("int")
    unnamed = F.col("SKU").isNull()
    salted = rows.withColumn("__salt", F.when(unnamed, spread).otherwise(-1 - spread))
    joined = salted.join(pairs, "__salt", "left")
    copies = F.explode_outer(F.sequence(F.lit(1).cast("long"), F.col("__copies")))
    return joined.withColumns(
        {"__copy": copies, **{n: F.when(unnamed, F.col(f"__{n}")).otherwise(F.col(n)) for n in names}}
    ).drop("__salt", "__copy", "__copies", *[f"__{n}" for n in names])


def partial_totals(base: DataFrame, keys: list[str]) -> DataFrame:
    """Sums and counts per ``keys``, lag and lead-time flag; such totals can be added up again."""
    return base.groupBy(*keys, "Lag", "Our_LT").agg(
        *[exact_sum(n).alias(n) for n in SUMS], F.count(F.lit(1)).alias("Num_SKUs")
    )


def merged_totals(partial: DataFrame, keys: list[str]) -> DataFrame:
    """Sums per view and ``keys`` from partial totals; the views are Lag 1, 2, 3 and the own lead time."""
    views = [F.when(F.col("Lag") == n, F.lit(f"Lag_{n}")) for n in LAGS]
    views.append(F.when(F.col("Our_LT"), F.lit("Our_LT")))
    tagged = partial.withColumn("View", F.explode(F.array_compact(F.array(*views))))
    return tagged.groupBy("View", *keys).agg(
        *[exact_total(n).alias(n) for n in SUMS], F.sum("Num_SKUs").alias("Num_SKUs")
    )


def view_totals(base: DataFrame, keys: list[str]) -> DataFrame:
    """Sums per view and ``keys``.

    A row can be in two views. Rows are first summed per lag and lead-time flag, so the copy per
    view is made of a few totals instead of the rows: one pass and one small shuffle for all views.
    ``base`` may be partial totals, as stored.
    """
    stored = "Num_SKUs" in base.columns
    return merged_totals(base if stored else partial_totals(base, keys), keys)


def accuracy_by_view(base: DataFrame) -> DataFrame:
    """Accuracy of the mean and shares at or under each quantile, per view and month."""
    t = view_totals(base, ["Fcst_Date", "Month", "Year"])
    return t.select(
        "View", "Fcst_Date", "Month", "Year", "Mean_Fcst", "Mean_ABS_Error", "Shipped_Units",
        "Num_SKUs",
        accuracy(F.col("Mean_ABS_Error"), F.col("Shipped_Units")).alias("Mean_Acc"),
        *[ratio(F.col(f"{q}_Below"), F.col("Num_SKUs")).alias(f"{q}_Below") for q in QUANTILES],
    )


def kpi_totals(base: DataFrame) -> DataFrame:
    """Twelve-month accuracy and shares under each quantile, in percent, per view."""
    t = view_totals(base, [])
    return t.select(
        "View",
        percent(accuracy(F.col("Mean_ABS_Error"), F.col("Shipped_Units"))).alias("Total_Acc"),
        *[
            percent(ratio(F.col(f"{q}_Below"), F.col("Num_SKUs"))).alias(f"{q}_Per")
            for q in QUANTILES
        ],
    )


def accuracy_trend_long(by_view: DataFrame) -> DataFrame:
    """Chart rows: one per view, month and measure, in percent, with a short month name."""
    return (
        by_view.select(
            "View", "Fcst_Date", month_short("Month").alias("Month"), "Year", *TREND_TYPES
        )
        .unpivot(["View", "Fcst_Date", "Month", "Year"], list(TREND_TYPES), "Type", "Value")
        .withColumn("Value", F.col("Value") * 100)
    )


def segment_rank(c: Column | str) -> Column:
    """Position on the report, NULL for a class that is not in the list."""
    listed = F.array(*[F.lit(s) for s in SEGMENT_ORDER])
    pos = F.array_position(listed, F.col(c) if isinstance(c, str) else c)
    return F.when(pos > 0, pos.cast("int"))


def accuracy_by_segment(base: DataFrame) -> DataFrame:
    """Accuracy in percent by demand category and by value class, per view.

    Rows are summed to (view, category, class) first; both groupings then come from one pass over
    those totals. ``grouping`` tells a rolled-up key from one that is NULL itself.
    """
    t = view_totals(base, ["DEMAND_CAT_CU", "ABC_REV_ITM_CU"])
    view, demand, abc = F.col("View"), F.col("DEMAND_CAT_CU"), F.col("ABC_REV_ITM_CU")
    g = t.groupingSets([[view, demand], [view, abc]], view, demand, abc).agg(
        exact_total("Mean_ABS_Error").alias("e"),
        exact_total("Shipped_Units").alias("s"),
        F.grouping("ABC_REV_ITM_CU").alias("by_demand"),
    )
    by_demand = F.col("by_demand") == 1
    return (
        g.withColumn("Seg_Cat", F.when(by_demand, demand).otherwise(abc))
        .where(F.col("Seg_Cat").isNotNull())
        .where(~(by_demand & F.col("Seg_Cat").isin(*UNREPORTED_DEMAND)))
        .select(
            "View",
            "Seg_Cat",
            segment_rank("Seg_Cat").alias("Seg_Order"),
            percent(accuracy(F.col("e"), F.col("s"))).alias("Mean_Acc"),
        )
    )

"""Month-end fact table: rework, variance against last month, forecast snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandmill.functions.rules import exact_total, half_even, if_known, match_join, not_in
from demandmill.functions.text import ALL_OTHER, ALL_OTHER_CODE

VERSION = "ME_Version_Date"
# Keys and metrics of the month-end table.
KEYS = (
    "ME_Version_Date", "Country", "Division", "Sales_Manager", "Director", "Customer", "SRP5",
    "SRP7", "Year", "Month", "FC_Date", "Month_No", "Conversion_Rate", "Month_Year", "Key",
    "Current_ME_Version", "Current_Month",
)
METRICS = ("Shipments", "Forecast", "Total_Possible", "Delta", "Actl_TP", "Actl_TP_Fcst")
COMBINED = "Actl_TP_Fcst_Delta"
# Fixed value: column order of the published table.
PUBLISHED = (
    "ME_Version_Date", "Country", "Division", "Sales_Manager", "Director", "Customer", "SRP5",
    "SRP7", "Year", "Month", "FC_Date", "Month_No", "Shipments", "Forecast", "Total_Possible",
    "Delta", "Actl_TP", "Actl_TP_Fcst", "Actl_TP_Fcst_Delta", "Conversion_Rate", "Month_Year",
    "Key", "Current_ME_Version", "Current_Month",
)

# Names used by the snapshot.
BY_MANAGER = "ALL OTHER BY SALES MANAGER"
FORECAST_TYPES = ("BF", "LE")
# Accounts that are not sales territories. Callers add managers by name.
HOUSE_ACCOUNTS = ("OWN E-COMMERCE", "OPEN GOVERNMENT")


def latest_version(df: DataFrame, version: dt.date | None = None) -> DataFrame:
    """Rows of the newest version, compared as dates.

    A caller who knows it names it: then one filter, which reaches the scan, and no look for it.
    """
    if version is not None:
        return df.where(F.col(VERSION) == F.lit(version))
    return df.where(F.col(VERSION) == df.agg(F.max(VERSION)).scalar())


def with_month_year(df: DataFrame) -> DataFrame:
    return df.withColumn("Month_Year", F.concat("Month", F.col("Year").cast("string")))


def directors(raw: DataFrame) -> DataFrame:
    """One director per sales manager; two different ones are an error."""
    name = F.coalesce("Director", F.lit(""))
    one = raw.groupBy("Sales_Manager").agg(
        F.max("Director").alias("Director"),
        F.min(name).alias("__low"),
        F.max(name).alias("__high"),
    )
    clash = F.concat(F.lit("more than one director for "), F.coalesce("Sales_Manager", F.lit("NA")))
    return one.select(
        "Sales_Manager",
        F.when(F.col("__low") == F.col("__high"), F.col("Director"))
        .otherwise(F.raise_error(clash))
        .alias("Director"),
    )


def fill_unknown(df: DataFrame, keys_too: bool) -> DataFrame:
    """Unknown metrics become 0; with ``keys_too`` unknown keys become 0 as well.

    Text keys then read ``0``, so their rows stay in a grouping that drops unknown keys. Dates
    cannot hold a 0 and stay unknown.
    """
    out: dict[str, Column] = {}
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if f.name in METRICS:
            out[f.name] = F.coalesce(f.name, F.lit(0.0))
        elif keys_too and kind != "date":
            out[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
    return df.withColumns(out)


def month_end_deltas(
    raw: DataFrame, deltas: DataFrame, fill_keys: bool = True, version: dt.date | None = None
) -> DataFrame:
    """Newest deltas with their director, in the column order of the raw table."""
    lookup = directors(latest_version(raw, version))
    rows = match_join(
        with_month_year(latest_version(deltas, version)).drop("Director"),
        lookup,
        [("Sales_Manager", "Sales_Manager")],
    )
    return fill_unknown(rows.select(*raw.columns), fill_keys)


def month_end_rework(
    raw: DataFrame, deltas: DataFrame, fill_keys: bool = True, version: dt.date | None = None
) -> DataFrame:
    """Raw table plus deltas, one row per key, with the combined column.

    Rows with an unknown key are dropped from the raw table; deltas keep theirs, filled.
    """
    return rework_with(raw, month_end_deltas(raw, deltas, fill_keys, version), version)


def rework_with(raw: DataFrame, ready: DataFrame, version: dt.date | None = None) -> DataFrame:
    """``month_end_rework`` from the result of ``month_end_deltas``, such as a written one."""
    rows = with_month_year(latest_version(raw, version)).select(*raw.columns)
    union = rows.unionByName(ready.select(*raw.columns))
    sums = union.dropna(subset=list(KEYS)).groupBy(*KEYS).agg(
        *[exact_total(m).alias(m) for m in METRICS]
    )
    return sums.withColumn(COMBINED, F.col("Actl_TP_Fcst") + F.col("Delta")).select(*PUBLISHED)


def month_end_rework_r(
    raw: DataFrame, deltas: DataFrame, pooled: bool = False, fill_keys: bool = True,
    version: dt.date | None = None,
) -> DataFrame:
    """The form without directors, in which unknown keys are kept.

    ``pooled`` gives rows that differ in nothing but the last key one common combined value.
    """
    keys = [c for c in KEYS if c != "Director"]
    rows = with_month_year(latest_version(raw, version)).drop("Director")
    extra = with_month_year(latest_version(deltas, version)).select(*rows.columns)
    union = rows.unionByName(fill_unknown(extra, fill_keys))
    sums = union.groupBy(*keys).agg(*[exact_total(m).alias(m) for m in METRICS])
    both = F.col("Actl_TP_Fcst") + F.col("Delta")
    if pooled:
        both = F.sum(both).over(Window.partitionBy(*keys[:-1]))
    return sums.withColumn(COMBINED, both).select(*[c for c in PUBLISHED if c != "Director"])


def manager_totals(df: DataFrame, year: int, excluded: list[str], name: str) -> DataFrame:
    """Thousands per sales manager of the pooled customer in one year."""
    mine = df.where((F.col("Customer") == ALL_OTHER_CODE) & (F.col("Year") == year)).where(
        not_in("Sales_Manager", excluded)
    )
    return mine.groupBy("Sales_Manager").agg(
        half_even(exact_total(COMBINED) / 1000, 1).alias(name)
    )


def variance_top_n(
    this_month: DataFrame,
    last_month: DataFrame,
    year: int,
    excluded: list[str],
    n: int = 10,
    how: str = "left",
) -> DataFrame:
    """Largest changes per sales manager against last month.

    ``how='full'`` also reports managers that only last month knows.
    """
    this = manager_totals(this_month, year, excluded, "TM_Total")
    last = manager_totals(last_month, year, excluded, "LM_Total")
    renamed = last.withColumnRenamed("Sales_Manager", "__last")
    both = this.join(renamed, F.col("Sales_Manager").eqNullSafe(F.col("__last")), how)
    changes = both.select(
        F.coalesce("Sales_Manager", "__last", F.lit("0")).alias("Sales_Manager"),
        F.coalesce("TM_Total", F.lit(0.0)).alias("TM_Total"),
        F.coalesce("LM_Total", F.lit(0.0)).alias("LM_Total"),
    ).where(not_in("Sales_Manager", [ALL_OTHER]))
    variance = F.col("TM_Total") - F.col("LM_Total")
    return (
        changes.withColumn("variance", variance)
        .withColumn("abs_variance", F.abs("variance"))
        .withColumn("color", F.when(F.col("variance") < 0, "below").otherwise("above"))
        .orderBy(F.desc("abs_variance"), F.desc("Sales_Manager"))
        .limit(n)
    )


def forecast_snapshot(
    month_end: DataFrame, history: DataFrame, version: dt.date | None = None
) -> DataFrame:
    """Future months of the current version as BF and LE, after the past months of this year.

    Column order and types follow the snapshot history. A named version saves running the month end a
    second time for its date.
    """
    version = month_end.agg(F.max(VERSION)).scalar() if version is None else F.lit(version)
    keys = ["Customer", "Division", "Country", "Sales_Manager", "Month_No", "Year"]
    future = month_end.where(F.col("FC_Date") > F.col(VERSION)).groupBy(*keys).agg(
        half_even(exact_total(COMBINED)).alias("Forecast_Plus_Delta")
    )
    relabelled = if_known(
        (F.col("Customer") == ALL_OTHER_CODE) & (F.col("Sales_Manager") != ALL_OTHER),
        F.lit(BY_MANAGER),
        F.col("Customer"),
    )
    tagged = future.withColumn(
        "Forecast_Type", F.explode(F.array(*[F.lit(t) for t in FORECAST_TYPES]))
    ).withColumn("Customer", relabelled)
    kept = history.where(
        (F.col("Month_No") <= F.month(version)) & (F.col("Year") == F.year(version))
    )
    return tagged.select(*history.columns).unionByName(kept)


def snapshot_export(snapshot: DataFrame) -> DataFrame:
    """Row order of the exported snapshot."""
    return snapshot.orderBy("Customer", "Forecast_Type", "Year", "Month_No")

"""Forecast accuracy from stored totals.

A cell is one version month and one target month. Its sums (exact decimals) and counts are stored per lag,
lead-time flag, category and class; views, KPIs, trend and segments are merged from the cells of the
window. Twelve months have at most some hundred cells, whatever the number of items.

A pointer names the run folder of every cell that counts (see ``sinks``), so a refresh that breaks
leaves the old totals whole, and a cell that lost all its rows counts no more.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandmill.functions.dates import add_months, month_range, trailing_year
from demandmill.operators import pos
from demandmill.sources import sinks

CELL = "Cell"
GROUPS = [
    "Fcst_Date", "Month", "Year", "Category", "Sub_Category", "DEMAND_CAT_CU", "ABC_REV_ITM_CU",
]
TOTALS = (
    "Fcst_Date date, Month string, Year int, Category string, Sub_Category string, DEMAND_CAT_CU string, "
    "ABC_REV_ITM_CU string, Lag int, Our_LT boolean, "
    + ", ".join(f"{n} decimal(38,10)" for n in pos.SUMS)
    + ", Num_SKUs bigint"
)
#: A lag names one version month as long as versions lie in these distances (months) from the target.
REACH = (-10, 12)


def _month_key(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def _key(month: dt.date) -> str:
    return f"{month:%Y-%m}"


def _targets(months: list[dt.date]) -> Column:
    """Rows of these target months, of versions within reach. Plain comparisons, for the scan."""
    version = F.col("POS_Fcst_Version_Date")
    return reduce(
        lambda a, b: a | b,
        [
            (F.col("Year") == m.year)
            & (F.col("Month_Num") == m.month)
            & (version >= F.lit(add_months(m, -REACH[1])))
            & (version < F.lit(add_months(m, 1 - REACH[0])))
            for m in months
        ],
        F.lit(False),
    )


def _versions(months: list[dt.date]) -> Column:
    version = F.col("POS_Fcst_Version_Date")
    return reduce(
        lambda a, b: a | b,
        [(version >= F.lit(m)) & (version < F.lit(add_months(m, 1))) for m in months],
        F.lit(False),
    )


def concerned(
    forecasts: DataFrame, fresh: list[dt.date], loaded: list[dt.date], window: list[dt.date]
) -> DataFrame:
    """Rows of fresh target months, and of loaded version months as far as their targets are in the window."""
    return forecasts.where(_targets(fresh) | (_versions(loaded) & _targets(window)))


def cells(base: DataFrame) -> DataFrame:
    """Mergeable totals of ``pos_accuracy_base`` with segments; ``Cell`` is version month~target month.

    A second-week version lies ``Lag`` months before its target, so the lag tells the version month.
    """
    version = F.add_months("Fcst_Date", -F.col("Lag"))
    return pos.partial_totals(base, GROUPS).withColumn(
        CELL, F.concat_ws("~", _month_key(version), _month_key(F.col("Fcst_Date")))
    )


def refresh(
    spark: SparkSession,
    root: str,
    forecasts: DataFrame,
    leadtimes: DataFrame,
    actuals: DataFrame,
    asof: dt.date,
    segments: DataFrame,
    versions: list[dt.date] = (),
    corrected: list[dt.date] = (),
    dedupe: bool = False,
    rebuild: bool = False,
) -> None:
    """Bring the stored totals up to ``asof``.

    Computed are the months of the window that the store does not know yet, the months named in
    ``corrected`` (their actuals changed), and the cells of the months of ``versions`` (a version that is
    new, or was loaded again). Other forecasts are filtered out at the scan. Cells before the window are
    left out. Changed lead times or segments concern every cell: ``rebuild``.

    Equal rows are made one within a version month; versions farther from their target than ``REACH``
    would share a lag with nearer ones and are left out, as are versions outside the second week.
    """
    first, last = trailing_year(asof)
    window = month_range(first, last)
    named = {} if rebuild else sinks.read_pointer(spark, root)
    changed = {m.replace(day=1) for m in corrected}
    fresh = [m for m in window if _key(m) not in named.get("months", []) or m in changed]
    loaded = sorted({v.replace(day=1) for v in versions})

    kept = {}
    for cell, run in named.get("cells", {}).items():
        version, target = cell.split("~")
        if _key(first) <= target <= _key(last) and target not in map(_key, fresh):
            if version not in map(_key, loaded):
                kept[cell] = run
    if fresh or loaded:
        rows = concerned(forecasts, fresh, loaded, window)
        base = pos.pos_accuracy_base(rows, leadtimes, actuals, asof, segments, dedupe)
        run = sinks.new_run()
        sinks.write_partitions(cells(base), f"{root}/{run}", [CELL])
        kept |= {cell: run for cell in sinks.partitions(spark, f"{root}/{run}", CELL)}
    sinks.switch_pointer(spark, root, {"months": [_key(m) for m in window], "cells": kept})


def read_totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals of all cells that count; only their folders are read."""
    named = sinks.read_pointer(spark, root)["cells"]
    reader = spark.read.schema(TOTALS)
    if not named:
        return spark.createDataFrame([], TOTALS)
    return reader.parquet(*[f"{root}/{run}/{CELL}={cell}" for cell, run in sorted(named.items())])

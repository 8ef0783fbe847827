"""Wide demand history to long rows and to one series per item."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandmill.functions.dates import month_range, parse_mdy
from demandmill.functions.text import quote
from demandmill.session import tasks_for

SERIES = "Nested_History"


def _months(wide: DataFrame) -> list[str]:
    """Month columns: everything after the item and the second, unused column."""
    return wide.columns[2:]


def history_long(wide: DataFrame) -> DataFrame:
    """``SKU, Date, History``: one row per month column, unknown demand is 0."""
    sku, months = wide.columns[0], _months(wide)
    long = wide.selectExpr(
        f"{quote(sku)} AS SKU", *[f"CAST({quote(c)} AS double) AS {quote(c)}" for c in months]
    ).unpivot(["SKU"], [quote(c) for c in months], "Date", "History")
    return long.select(
        "SKU",
        parse_mdy("Date").alias("Date"),
        F.coalesce("History", F.lit(0.0)).alias("History"),
    )


def complete_calendar(long: DataFrame) -> DataFrame:
    """Every item has every month between the first and the last month of the table.

    Rows are summed per item and month, so a month that occurs twice is added up and an item's
    known months are few enough to travel as one map. The months are then written out beside the
    map: no cross join, and the rows that are added never enter a shuffle.
    """
    first = long.agg(F.trunc(F.min("Date"), "MM")).scalar()
    last = long.agg(F.trunc(F.max("Date"), "MM")).scalar()
    # A row without a date belongs to no month.
    dated = long.where(F.col("Date").isNotNull())
    monthly = dated.groupBy("SKU", F.trunc("Date", "MM").alias("Date")).agg(
        F.sum("History").alias("History")
    )
    known = monthly.groupBy("SKU").agg(
        F.map_from_entries(F.collect_list(F.struct("Date", "History"))).alias("__known")
    )
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return known.select("SKU", "__known", F.explode(months).alias("Date")).select(
        "SKU", "Date", F.coalesce(F.try_element_at("__known", "Date"), F.lit(0.0)).alias("History")
    )


def nest_history(long: DataFrame) -> DataFrame:
    """One ordered series per item from a table with one row per item and month.

    A series holds one entry per month of the calendar, whatever the number of source rows.
    """
    return long.groupBy("SKU").agg(
        F.array_sort(F.collect_list(F.struct("Date", "History"))).alias(SERIES)
    )


def history_series(wide: DataFrame) -> DataFrame:
    """One ordered, gap-free series per item, straight from the wide table.

    The month columns are the series: they are summed per item (an item listed twice is added up)
    and packed in calendar order. Months that have no column are 0 for every item. Items are dealt out
    by the size of the files, so a task holds no more of them as the table grows; a table that already
    lies so is not shuffled again.
    """
    sku = F.col(quote(wide.columns[0]))
    names = {_header_date(c): quote(c) for c in _months(wide)}
    summed = wide.repartition(tasks_for(wide), sku).groupBy(sku.alias("SKU")).agg(
        *[F.expr(f"sum(CAST({c} AS double)) AS {c}") for c in names.values()]
    )
    points = [
        f"struct(DATE'{d}' AS Date, coalesce({names.get(d, 'NULL')}, 0.0D) AS History)"
        for d in month_range(min(names), max(names))
    ]
    return summed.select("SKU", F.expr(f"array({', '.join(points)})").alias(SERIES))


def _header_date(name: str) -> dt.date:
    month, _, year = name.split("/")
    return dt.date(int(year), int(month), 1)


def values_of(series: Column | str = SERIES) -> Column:
    """The demand values of a series as ``array<double>``."""
    c = F.col(series) if isinstance(series, str) else series
    return c.getField("History")


def dates_of(series: Column | str = SERIES) -> Column:
    c = F.col(series) if isinstance(series, str) else series
    return c.getField("Date")

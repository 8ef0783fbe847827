"""Month arithmetic and labels."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandmill.functions.rules import col

# English month names and their abbreviations, January first.
MONTH_NAMES = tuple(calendar.month_name[1:])
MONTH_ABBR = tuple(calendar.month_abbr[1:])


def add_months(d: dt.date, n: int) -> dt.date:
    """First of the month ``n`` months after the month of ``d``."""
    k = d.year * 12 + d.month - 1 + n
    return dt.date(k // 12, k % 12 + 1, 1)


def month_range(first: dt.date, last: dt.date) -> list[dt.date]:
    n = (last.year - first.year) * 12 + last.month - first.month
    return [add_months(first, i) for i in range(n + 1)]


def trailing_year(asof: dt.date) -> tuple[dt.date, dt.date]:
    """First and last of the twelve complete months before ``asof``."""
    last = add_months(asof, -1)
    return add_months(last, -11), last


def month_floor(c: Column | str) -> Column:
    return F.trunc(col(c), "MM")


def month_label(c: Column | str) -> Column:
    """``Jan_2020``."""
    return F.date_format(col(c), "MMM_yyyy")


def label_of(d: dt.date) -> str:
    return f"{MONTH_ABBR[d.month - 1]}_{d.year}"


def header_of(d: dt.date) -> str:
    """Month as an export column name, ``1/1/2020``."""
    return f"{d.month}/1/{d.year}"


def parse_mdy(c: Column | str) -> Column:
    """``1/5/2020`` to a date, anything else to NULL."""
    return F.try_to_date(col(c), "M/d/yyyy")


def _lookup(keys: tuple, values: tuple) -> Column:
    items = [F.lit(x) for pair in zip(keys, values) for x in pair]
    return F.create_map(*items)


def month_number(name: Column | str) -> Column:
    """``June`` to 6, unknown names to NULL."""
    return F.try_element_at(_lookup(MONTH_NAMES, tuple(range(1, 13))), col(name))


def month_full(abbr: Column | str) -> Column:
    """``Jun`` to ``June``, unknown names to NULL."""
    return F.try_element_at(_lookup(MONTH_ABBR, MONTH_NAMES), col(abbr))


def month_short(name: Column | str) -> Column:
    """``June`` to ``Jun``, unknown names to NULL."""
    return F.try_element_at(_lookup(MONTH_NAMES, MONTH_ABBR), col(name))


def upper_month_label(month: Column | str, year: Column | str) -> Column:
    """``JANUARY`` and 2020 to ``Jan_2020``."""
    return F.concat(F.initcap(F.substring(col(month), 1, 3)), F.lit("_"), col(year).cast("string"))


def month_lag(version: Column | str, target: Column | str) -> Column:
    """Months component of the span from version to target, plus 1."""
    whole = F.floor(F.months_between(col(target), col(version)))
    return (whole % 12 + 1).cast("int")

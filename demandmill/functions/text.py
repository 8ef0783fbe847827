"""Report text to numbers, names to canonical names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandmill.functions.rules import col

# Characters removed before a cell is read as a number.
MONEY_MARKS = "$,()"
PERCENT_MARKS = "%,"
PLAIN_PERCENT_MARKS = "%"
COUNT_MARKS = ","

# Customer names written in one way, applied in this order.
ALL_OTHER_CODE = "ALL OTHER - (G45)"
ALL_OTHER = "ALL OTHER"
CUSTOMER_MARKS = ("DO IT BEST", "MEIJER", "ORGILL", "TRUE VALUE")

BLANKS = " \t\r\n"


def number_sql(cell: str, marks: str) -> str:
    """SQL text that reads a cell, without ``marks``, as a double; other text gives NULL.

    Java also reads ``5d``, ``NaN`` and ``Infinity``, which are not numbers in a report. With its own
    ``D`` added at the end only plain numbers remain readable.
    """
    for mark in marks:
        cell = f"replace({cell}, '{mark}', '')"
    return f"try_cast(concat(trim({cell}), 'D') AS double)"


def quote(name: str) -> str:
    return f"`{name}`"


def money(name: str, paren_negative: bool = False) -> Column:
    """``$1,234.50`` to 1234.5. ``(5)`` is 5, or -5 with ``paren_negative``."""
    cell = quote(name)
    value = number_sql(cell, MONEY_MARKS)
    if paren_negative:
        value = f"IF(trim({cell}) LIKE '%(%)', -{value}, {value})"
    return F.expr(value)


def percent_text(name: str) -> Column:
    """``1,234%`` to 12.34."""
    return F.expr(f"{number_sql(quote(name), PERCENT_MARKS)} / 100")


def plain_percent_text(name: str) -> Column:
    """Percent whose thousands mark is not understood: ``1,234%`` is NULL."""
    return F.expr(f"{number_sql(quote(name), PLAIN_PERCENT_MARKS)} / 100")


def count_text(name: str) -> Column:
    """``1,234`` to 1234."""
    return F.expr(number_sql(quote(name), COUNT_MARKS))


def without_nul(c: Column | str) -> Column:
    # A text without the mark is handed on as it is; translate() would build every text anew.
    return F.replace(col(c), F.lit("\u0000"), F.lit(""))


def canonical_customer(c: Column | str) -> Column:
    """Upper case, then the coded name, then blanks, then names recognised by a part of them.

    The coded name is compared before blanks are trimmed, so `` ALL OTHER - (G45)`` with a leading
    blank keeps its code.
    """
    up = F.upper(col(c))
    coded = F.when(up == ALL_OTHER_CODE, F.lit(ALL_OTHER)).otherwise(up)
    name = F.trim(coded, F.lit(BLANKS))
    chain = F.when(name.contains(CUSTOMER_MARKS[0]), F.lit(CUSTOMER_MARKS[0]))
    for mark in CUSTOMER_MARKS[1:]:
        chain = chain.when(name.contains(mark), F.lit(mark))
    return chain.otherwise(name)


def first_token(c: Column | str) -> Column:
    """Text before the first blank."""
    return F.substring_index(col(c), " ", 1)

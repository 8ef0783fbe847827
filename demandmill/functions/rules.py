"""Numeric and NULL rules shared by every operator.

The source scripts rely on the missing-value and rounding rules of their own languages. Each rule
that decides a result is one small column expression here, so the operators stay plain plans.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Exact, so a sum does not depend on the order of partitions; ten places, as in ``TIE``.
EXACT = "decimal(28,10)"
# Scale at which binary noise is removed before a tie is decided.
TIE = "decimal(38,10)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even(x: Column | str, digits: int = 0) -> Column:
    """Round half to even; the tie is decided on the decimal value, not on its binary form."""
    return F.bround(col(x).cast(TIE), digits).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """Division that gives NULL for a zero base."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def exact_sum(x: Column | str) -> Column:
    """Decimal sum, equal whatever the partitioning; NULL when no value is known."""
    return F.sum(col(x).cast(EXACT))


def exact_total(x: Column | str) -> Column:
    """``exact_sum`` as a number; 0 when no value is known."""
    return F.coalesce(exact_sum(x).cast("double"), F.lit(0.0))


def strict_sum(x: Column | str) -> Column:
    """Sum that is NULL as soon as one value of the group is NULL."""
    c = col(x)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def not_in(x: Column | str, values: Iterable[object]) -> Column:
    """Negated membership that keeps NULL."""
    return ~F.coalesce(col(x).isin(list(values)), F.lit(False))


def if_known(cond: Column, yes: Column, no: Column) -> Column:
    """Two-way choice; an unknown condition gives NULL instead of the second value."""
    return F.when(cond, yes).when(~cond, no)


def floor_zero(x: Column) -> Column:
    """Negative values become 0; NULL stays NULL."""
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def accuracy(abs_error: Column, base: Column) -> Column:
    """1 - |error| / base, NULL for a zero base."""
    return F.lit(1.0) - ratio(abs_error, base)


def clamped_accuracy(abs_error: Column, base: Column) -> Column:
    """Accuracy not below 0. A zero base with an error counts as 0, without one as unknown."""
    return F.when((base == 0) & (abs_error > 0), F.lit(0.0)).otherwise(
        floor_zero(accuracy(abs_error, base))
    )


def percent(x: Column, digits: int = 2) -> Column:
    return half_even(x * 100, digits)


def paste(*parts: Column | str) -> Column:
    """Concatenate; an unknown part is written as NA."""
    return F.concat(*[F.coalesce(col(p).cast("string"), F.lit("NA")) for p in parts])


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def match_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str = "left",
    tasks: int | None = None,
) -> DataFrame:
    """Equi-join on (left, right) column pairs in which NULL matches NULL.

    The right key columns are dropped. No broadcast hint: the planner broadcasts a side whose
    statistics (or, adaptively, whose shuffled size) are under ``autoBroadcastJoinThreshold`` and
    otherwise runs a sort-merge join whose hot partitions are split at run time. With ``tasks`` both
    sides are dealt out by their keys to that many tasks. The keys then meet as one struct, in which NULL
    equals NULL; they must have the same types on both sides.
    """
    if tasks:
        return _dealt_join(left, right, pairs, how, tasks)
    renamed = right
    tagged = []
    for i, (lk, rk) in enumerate(pairs):
        renamed = renamed.withColumnRenamed(rk, f"__key{i}")
        tagged.append((lk, f"__key{i}"))
    cond = all_of(F.col(lk).eqNullSafe(F.col(rk)) for lk, rk in tagged)
    return left.join(renamed, cond, how).drop(*[rk for _, rk in tagged])


def _dealt_join(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str, tasks: int
) -> DataFrame:
    def keyed(df: DataFrame, names: Iterable[str], key: str) -> DataFrame:
        parts = [F.col(n).alias(f"k{i}") for i, n in enumerate(names)]
        return df.withColumn(key, F.struct(*parts)).repartition(tasks, key)

    lefts, rights = zip(*pairs)
    dealt = keyed(right, rights, "__right").drop(*rights)
    joined = keyed(left, lefts, "__left").join(dealt, F.col("__left") == F.col("__right"), how)
    return joined.drop("__left", "__right")

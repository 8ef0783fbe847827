"""Top rows per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandmill.functions.rules import match_join


def top_n_with_ties(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """Rows whose value ranks n-th or better within its group; ties at the end are all kept.

    Ranking whole groups would bring a hot group into one task. Here rows are counted per distinct
    value first, each group's lowest kept value is found on at most n distinct values, and rows
    are then filtered against it. Rows with an unknown value are dropped.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("__n")
    )
    best_first = Window.partitionBy(*keys).orderBy(F.desc(value))
    # The row_number filter comes first: it is applied before the shuffle, per input partition.
    best = counts.withColumn("__pos", F.row_number().over(best_first)).where(F.col("__pos") <= n)
    above = F.sum("__n").over(best_first.rowsBetween(Window.unboundedPreceding, -1))
    kept = best.withColumn("__above", F.coalesce(above, F.lit(0))).where(F.col("__above") < n)
    lowest = kept.groupBy(*keys).agg(F.min(value).alias("__lowest"))
    return (
        match_join(df, lowest, [(k, k) for k in keys], how="inner")
        .where(F.col(value) >= F.col("__lowest"))
        .drop("__lowest")
    )

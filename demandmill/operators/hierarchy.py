"""Accuracy over the product hierarchy, and the rows of its tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandmill.functions.rules import (
    clamped_accuracy,
    exact_sum,
    exact_total,
    if_known,
    match_join,
    paste,
    percent,
)
from demandmill.operators.ranking import top_n_with_ties

# Categories of each division; any other category is GOL.
WATERING = "WATERING"
SOC_CATEGORIES = ("TOTAL SCISSORS", "COOKING", "CREATING", "ALL OTHER SOC")

LEVELS = ("Div", "Category", "Sub_Category", "SKU")
TREE_LIMIT = 50

# Tree colour of each value class; any other class is yellow.
CLASS_COLOURS = {"A": "red", "B": "green"}
OTHER_COLOUR = "yellow"


def division_of(category: Column | str) -> Column:
    c = F.col(category) if isinstance(category, str) else category
    return if_known(
        c == WATERING, F.lit("WAT"), if_known(c.isin(*SOC_CATEGORIES), F.lit("SOC"), F.lit("GOL"))
    )


def own_leadtime_rows(base: DataFrame) -> DataFrame:
    return base.where(F.col("Our_LT")).withColumn("Div", division_of("Category"))


def hierarchy_accuracy(base: DataFrame) -> DataFrame:
    """Accuracy in percent, not below 0, of every division, category, sub-category and item.

    Each level is pooled over its own name alone. Rows are summed to the four keys before the
    grouping sets copy them, so the copies are of totals.
    """
    keys = [F.col(c) for c in LEVELS]
    small = own_leadtime_rows(base).groupBy(*keys).agg(
        exact_sum("Mean_ABS_Error").alias("e"), exact_sum("Shipped_Units").alias("s")
    )
    sets = small.groupingSets([[k] for k in keys], *keys).agg(
        exact_total("e").alias("Mean_ABS_Error"),
        exact_total("s").alias("Shipped_Units"),
        *[F.grouping(c).alias(f"__{c}") for c in LEVELS],
    )
    level, member = F.lit(None).cast("string"), F.lit(None).cast("string")
    for c in LEVELS:
        level = F.when(F.col(f"__{c}") == 0, F.lit(c)).otherwise(level)
        member = F.when(F.col(f"__{c}") == 0, F.col(c)).otherwise(member)
    return sets.select(
        level.alias("Level"),
        member.alias("Member"),
        "Mean_ABS_Error",
        "Shipped_Units",
        percent(clamped_accuracy(F.col("Mean_ABS_Error"), F.col("Shipped_Units"))).alias("Acc"),
    )


def label(name: str, acc: str) -> Column:
    """``name (85.5% )``; whole numbers are written without decimals."""
    digits = F.regexp_replace(F.col(acc).cast("string"), r"\.0$", "")
    return paste(F.col(name), F.lit(" ("), digits, F.lit("% )"))


def representatives(rows: DataFrame) -> DataFrame:
    """One row per classed item: most shipped units, then latest month.

    ``max`` of a struct is combined before the shuffle, so an item with many rows sends one row per
    task. The class is tested inside it and not by a filter: the rows below stay the same ones the
    accuracies are made from, and Spark computes them once for both.
    """
    order = [
        "Shipped_Units", "Fcst_Date", "Product_Title", "Div", "Category", "Sub_Category",
        "DEMAND_CAT_CU", "ABC_REV_ITM_CU", "Mean_Fcst", "Mean_ABS_Error",
    ]
    classed = F.when(F.col("ABC_REV_ITM_CU").isNotNull(), F.struct(*order))
    best = rows.groupBy("SKU").agg(F.max(classed).alias("r"))
    return best.where(F.col("r").isNotNull()).select("SKU", "r.*")


def hierarchy_tree_rows(base: DataFrame, limit: int = TREE_LIMIT) -> DataFrame:
    """Tree rows: one per classed item, labels with accuracies, best sellers per sub-category."""
    rows = own_leadtime_rows(base)
    acc = hierarchy_accuracy(base).select("Level", "Member", "Acc")
    tree = representatives(rows)
    kept = top_n_with_ties(tree, ["Sub_Category"], "Shipped_Units", limit)
    # Labels are added to the rows that stay; a level's label is a function of its name, so
    # selecting by name and selecting by label give the same rows.
    for name in LEVELS:
        one = acc.where(F.col("Level") == name).select(
            F.col("Member").alias("__m"), F.col("Acc").alias("__acc")
        )
        kept = match_join(kept, one, [(name, "__m")])
        kept = kept.withColumn(f"__{name}", label(name, "__acc")).drop("__acc")
    abc = F.col("ABC_REV_ITM_CU")
    colour = F.when(abc == "A", F.lit(CLASS_COLOURS["A"])).when(
        abc == "B", F.lit(CLASS_COLOURS["B"])
    )
    return kept.select(
        *[F.col(f"__{c}").alias(c) for c in LEVELS],
        "Product_Title", "DEMAND_CAT_CU", "ABC_REV_ITM_CU", "Mean_Fcst", "Mean_ABS_Error",
        "Shipped_Units",
        colour.otherwise(F.lit(OTHER_COLOUR)).alias("abc_col"),
    )

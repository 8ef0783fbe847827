"""Accuracy tables of several sources in one form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandmill.functions.dates import month_full
from demandmill.functions.rules import clamped_accuracy, half_even, if_known, paste, ratio
from demandmill.functions.text import canonical_customer, first_token
from demandmill.operators.reports import quoted

# Constant columns of the second business unit.
DIVISION = "OUR"
TOP_CATEGORY = "RECREATION"
HOME = "United States"

# Source columns that carry the corrected costs, per yearly layout.
COST_COLUMNS = {
    "this_year": ("Forecast Cost Corrected", "Order Cost Corrected"),
    "last_year": ("Adjusted Forecast Cost", "Adjusted Order Cost"),
}


def harmonise_accuracy(source: DataFrame, layout: str) -> DataFrame:
    """Yearly accuracy sheet to the 23 common columns; promotions and new products are left out."""
    fcst_cost, order_cost = COST_COLUMNS[layout]
    pieces = F.split("Month", "/")
    month = month_full(F.get(pieces, 1))
    country = if_known(quoted("US/INT") == HOME, F.lit("USA"), F.lit("CANADA"))
    columns: dict[str, Column] = {
        "Year": F.get(pieces, 0),
        "Month": month,
        "MonthYear": paste(month, F.lit(" "), F.get(pieces, 0)),
        "Country": country,
        "SKU Number": first_token(quoted("Item Num/Desc")),
        "Sales Rep Key": paste(country, "Customer", F.lit(TOP_CATEGORY)),
        "Cost": half_even(ratio(quoted("Order Cost $"), quoted("Order Units")), 2),
        "Division": F.lit(DIVISION),
        "Customer": F.col("Customer"),
        "Category (SRP 5)": F.lit(TOP_CATEGORY),
        "Sub-Category (SRP 7)": F.col("Category"),
        "SKU": quoted("Item Num/Desc"),
        "LT Forecast - Units": quoted("Forecast Units"),
        "LT Forecast - Cost": quoted("Forecast Cost $"),
        "Orders - Units": quoted("Order Units"),
        "Orders - Cost": quoted("Order Cost $"),
        "Adjustment Request": quoted("Reason For Adjustment"),
        "Forecast Adjustments": quoted("Forecast Unit Adjustment"),
        "Adjusted FC - Units": quoted("Forecast Units Corrected"),
        "Adjusted FC - Cost": half_even(quoted(fcst_cost)),
        "Order Adjustments": quoted("Order Unit Adjustment"),
        "Adjusted Orders - Units": quoted("Order Units Corrected"),
        "Adjusted Orders - Cost": half_even(quoted(order_cost)),
    }
    return source.where(quoted("Promo/NPD?") == "No").select(
        *[c.alias(n) for n, c in columns.items()]
    )


def error_metrics(df: DataFrame) -> DataFrame:
    """Error, absolute, percent error, accuracy not below 0, and bias, for units and cost."""
    out = df
    for basis in ("Units", "Cost"):
        orders = quoted(f"Adjusted Orders - {basis}")
        error = orders - quoted(f"Adjusted FC - {basis}")
        ape = half_even(ratio(F.abs(error), orders), 2)
        # The percent error is rounded before the accuracy is taken from it.
        acc = F.when(ape.isNull(), clamped_accuracy(F.abs(error), orders)).otherwise(
            F.greatest(1 - ape, F.lit(0.0))
        )
        out = out.withColumns(
            {
                f"Error - {basis}": error,
                f"ABS Error - {basis}": F.abs(error),
                f"ABS Percent Error - {basis}": ape,
                f"Accuracy - {basis}": half_even(acc, 2),
                f"Bias - {basis}": half_even(-ratio(error, orders), 2),
            }
        )
    return out


def combine_units(*parts: DataFrame) -> DataFrame:
    """Union of harmonised tables with one spelling per customer."""
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.withColumn("Customer", canonical_customer("Customer"))

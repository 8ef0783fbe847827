"""Column layouts of the raw files and tables.

Raw report columns are known by position; every raw column is read as text and cleaned by the rule
of its layout. The names below are fixed values: results carry them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Layout:
    """Names in file order and the cleaning rule of each column.

    Columns in ``money``, ``count`` and ``text`` follow that rule; the rest are percentages.
    """

    name: str
    columns: tuple[str, ...]
    money: tuple[str, ...] = ()
    count: tuple[str, ...] = ()
    text: tuple[str, ...] = ("ASIN", "UPC", "Product_Title")
    plain_percent: bool = False
    rules: dict[str, str] = field(default_factory=dict, compare=False)

    def __post_init__(self) -> None:
        percent = "plain_percent" if self.plain_percent else "percent"
        for c in self.columns:
            self.rules[c] = (
                "text" if c in self.text
                else "money" if c in self.money
                else "count" if c in self.count
                else percent
            )

    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


SALES = Layout(
    "sales",
    (
        "ASIN", "UPC", "Product_Title", "Ordered_Revenue", "Ordered_Revenue_Per_of_Total",
        "Ordered_Revenue_Prior_Period_Per_Growth", "Ordered_Revenue_LY_Per_Growth",
        "Ordered_Units", "Ordered_Units_Per_Total", "Ordered_Units_Prior_Period_Per_Growth",
        "Ordered_Units_LY_Per_Growth", "Subcategory_Sales_Rank", "Subcategory_Better_Worse_Per",
        "Average_Sales_Price", "Average_Sales_Price_Prior_Period_Per",
        "Change_GV_Prior_Period_Per", "Change_GV_LY_Per", "Rep_OOS_Per", "Rep_OOS_Per_Total",
        "Rep_OOS_Prior_Period_Per_Growth", "LBB_Price_Per",
    ),
    money=("Ordered_Revenue", "Ordered_Units", "Subcategory_Sales_Rank", "Average_Sales_Price"),
)

SHIPPED = Layout(
    "shipped",
    (
        "ASIN", "UPC", "Product_Title", "Shipped_Revenue", "Shipped_Revenue_Per_of_Total",
        "Shipped_Revenue_Prior_Period_Per_Growth", "Shipped_Revenue_LY_Per_Growth",
        "Shipped_Units", "Shipped_Units_Per_Total", "Shipped_Units_Prior_Period_Per_Growth",
        "Shipped_Units_LY_Per_Growth", "Ordered_Units", "Ordered_Units_Per_Total",
        "Ordered_Prior_Period_Per_Growth", "Ordered_Units_LY_Per_Growth", "Customer_Returns",
        "Free_Replacements", "Subcategory_Sales_Rank", "Subcategory_Better_Worse_Per",
        "Average_Sales_Price", "Average_Sales_Price_Prior_Period_Per",
        "Change_GV_Prior_Period_Per", "Change_GV_LY_Per", "Rep_OOS_Per", "Rep_OOS_Per_Total",
        "Rep_OOS_Prior_Period_Per_Growth", "LBB_Price_Per",
    ),
    money=(
        "Shipped_Revenue", "Shipped_Units", "Ordered_Units", "Customer_Returns",
        "Free_Replacements", "Subcategory_Sales_Rank", "Average_Sales_Price",
    ),
)

TRAFFIC = Layout(
    "traffic",
    (
        "ASIN", "UPC", "Product_Title", "Per_Total_GVs", "Per_Change_GV_VS_Prior_Period",
        "Per_Change_GV_VS_LY", "Unique_Visitors_Prior_Period", "Unique_Visitors_LY",
        "Conversion_Percentile", "Per_Change_In_Conversion_VS_Prior_Period",
        "Per_Change_In_Conversion_VS_LY", "Fast_Track_Glance_View_Per",
        "Per_Change_Fast_Track_Glance_View_VS_Prior_Period", "Per_Change_Glance_View_VS_LY",
    ),
    plain_percent=True,
)

INVENTORY_HEALTH = Layout(
    "inventory_health",
    (
        "ASIN", "UPC", "Product_Title", "Net_Received_$", "Net_Received_Units",
        "Sell_Through_Rate", "Open_Purchase_Order_Qty", "Sellable_On_Hand_Inv_$",
        "Sellable_On_Hand_Inv_$_Trailing_30_Day_Avg", "Sellable_On_Hand_Units",
        "Unsellable_On_Hand_Inv_$", "Unsellable_On_Hand_Inv_$_Trailing_30_Day_Avg",
        "Unsellable_On_Hand_Units", "Aged_90_Days_Sellable_Inv_$",
        "Aged_90_Days_Sellable_Inv_$_Trailing_30_Day_Avg", "Aged_90_Days_Sellable_Inv_Units",
        "Unhealthy_Inv_$", "Unhealthy_Inv_Trailing_30_Day_Avg", "Unhealthy_Units",
        "Replenishment_Category",
    ),
    money=(
        "Net_Received_$", "Net_Received_Units", "Open_Purchase_Order_Qty",
        "Sellable_On_Hand_Inv_$", "Sellable_On_Hand_Inv_$_Trailing_30_Day_Avg",
        "Sellable_On_Hand_Units", "Unsellable_On_Hand_Inv_$",
        "Unsellable_On_Hand_Inv_$_Trailing_30_Day_Avg", "Unsellable_On_Hand_Units",
        "Aged_90_Days_Sellable_Inv_$", "Aged_90_Days_Sellable_Inv_$_Trailing_30_Day_Avg",
        "Aged_90_Days_Sellable_Inv_Units", "Unhealthy_Inv_$",
        "Unhealthy_Inv_Trailing_30_Day_Avg", "Unhealthy_Units",
    ),
    text=("ASIN", "UPC", "Product_Title", "Replenishment_Category"),
)

REVIEWS = Layout(
    "reviews",
    (
        "ASIN", "UPC", "Product_Title", "Number_Customer_Reviews",
        "Number_Customer_Reviews_Prior_Period", "Number_Customer_Reviews_Life_to_Date",
        "Average_Customer_Review", "Average_Customer_Review_Prior_Period",
        "Average_customer_Review_Life_to_Date", "5_Stars", "4_Stars", "3_Stars", "2_Stars",
        "1_Star",
    ),
    count=(
        "Number_Customer_Reviews", "Number_Customer_Reviews_Prior_Period",
        "Number_Customer_Reviews_Life_to_Date", "Average_Customer_Review",
        "Average_Customer_Review_Prior_Period", "Average_customer_Review_Life_to_Date",
        "5_Stars", "4_Stars", "3_Stars", "2_Stars", "1_Star",
    ),
)

INVENTORY = Layout(
    "inventory",
    (
        "ASIN", "UPC", "Product_Title", "Per_Rep_OOS", "Rep_OOS_%_of_Total",
        "Rep_OOS_Per_Prior_Period", "Ordered_Units", "Ordered_Units_Prior_Period_Per",
        "Unfilled_Customer_Ordered_Units", "Available_Inventory",
        "Available_Inventory_Prior_Period_Per", "Weeks_On_Hand", "Open_Purchase_Order_Qty",
        "Open_Purchase_Order_Qty_Prior_Period_Per", "Receive_Fill_Rate_Per",
        "Overall_Vendor_Lead_Time_Days", "Replenishment_Category",
    ),
    money=(
        "Ordered_Units", "Unfilled_Customer_Ordered_Units", "Available_Inventory",
        "Weeks_On_Hand", "Open_Purchase_Order_Qty", "Overall_Vendor_Lead_Time_Days",
    ),
    text=("ASIN", "UPC", "Product_Title", "Replenishment_Category"),
)

MONTHLY_LAYOUTS = {x.name: x for x in (SALES, SHIPPED, TRAFFIC, INVENTORY_HEALTH, REVIEWS)}

# Shape of the weekly file.
WEEKS = 26
MEASURES = {"Mean_Fcst": "Mean", "P70_Fcst": "P70", "P80_Fcst": "P80", "P90_Fcst": "P90"}


def week_column(week: int, measure: str) -> str:
    """Header of one weekly cell, e.g. ``Week 3 - P70 Forecast``."""
    return f"Week {week} - {MEASURES[measure]} Forecast"


TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "date": T.DateType(), "bigint": T.LongType(), "timestamp_ntz": T.TimestampNTZType(),
}


def schema_of(fields: str) -> T.StructType:
    """Schema from ``name type`` pairs; needs no session, so it can be a module constant."""
    pairs = [f.split() for f in fields.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


FORECAST_MONTHLY = schema_of(
    "POS_Fcst_Version_Date date, ASIN string, UPC string, Product_Title string, Month_Num int, "
    "Month string, Year int, Mean_Fcst double, P70_Fcst double, P80_Fcst double, P90_Fcst double"
)

LEADTIMES = schema_of(
    "ASIN string, SKU string, Our_LT int, Category string, Sub_Category string"
)

SEGMENTS = schema_of(
    "COMPANY string, CUSTOMER string, ITEM_NUMBER string, DEMAND_CAT_CU string, "
    "ABC_REV_ITM_CU string"
)

MONTH_END = schema_of(
    "ME_Version_Date date, Country string, Division string, Sales_Manager string, "
    "Director string, Customer string, SRP5 string, SRP7 string, Year int, Month string, "
    "FC_Date date, Month_No int, Shipments double, Forecast double, Total_Possible double, "
    "Delta double, Actl_TP double, Actl_TP_Fcst double, Conversion_Rate double, "
    "Month_Year string, Key string, Current_ME_Version string, Current_Month string"
)

SNAPSHOT = schema_of(
    "Customer string, Division string, Country string, Sales_Manager string, Month_No int, "
    "Year int, Forecast_Type string, Forecast_Plus_Delta double"
)

# The combined accuracy table, 23 carried columns and 10 metrics.
COMBINED_CARRIED = (
    "Year", "Month", "MonthYear", "Country", "SKU Number", "Sales Rep Key", "Cost", "Division",
    "Customer", "Category (SRP 5)", "Sub-Category (SRP 7)", "SKU", "LT Forecast - Units",
    "LT Forecast - Cost", "Orders - Units", "Orders - Cost", "Adjustment Request",
    "Forecast Adjustments", "Adjusted FC - Units", "Adjusted FC - Cost", "Order Adjustments",
    "Adjusted Orders - Units", "Adjusted Orders - Cost",
)
COMBINED_METRICS = tuple(
    f"{m} - {basis}"
    for basis in ("Units", "Cost")
    for m in ("Error", "ABS Error", "ABS Percent Error", "Accuracy", "Bias")
)
COMBINED_TEXT = COMBINED_CARRIED[:6] + COMBINED_CARRIED[7:12] + COMBINED_CARRIED[16:17]
COMBINED = T.StructType(
    [
        T.StructField(c, T.StringType() if c in COMBINED_TEXT else T.DoubleType())
        for c in COMBINED_CARRIED + COMBINED_METRICS
    ]
)

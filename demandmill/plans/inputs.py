"""Stand-ins for the planning tables, derived from the star-schema test tables.

Every input is computed by Spark from whole tables. The rules below are repeated, independently, in
SQL in ``oracle.py``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandmill.functions.dates import header_of, month_range
from demandmill.functions.text import ALL_OTHER, ALL_OTHER_CODE
from demandmill.operators.monthend import HOUSE_ACCOUNTS
from demandmill.session import tasks_for
from demandmill.sources.layouts import (
    INVENTORY,
    MEASURES,
    WEEKS,
    Layout,
    schema_of,
    week_column,
)

# Calendar of the test tables.
FIRST_MONTH, LAST_MONTH = dt.date(1995, 1, 1), dt.date(2001, 11, 1)
MONTHS = month_range(FIRST_MONTH, LAST_MONTH)
ASOF = dt.date(2001, 10, 15)
FIRST_FILE = dt.date(1995, 1, 2)
LAST_VERSION, THIS_VERSION = dt.date(2001, 3, 31), dt.date(2001, 4, 30)
COMPANY, CUSTOMER = "MAIN COMPANY", "MAIN CUSTOMER"
EXCLUDED_MANAGERS = ["NATION_7", "NATION_8", *HOUSE_ACCOUNTS]

MONEY = "decimal(18,2)"

# Schemas of the test tables; declared, so that opening a table starts no job.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


#: Deals out the numbers that a report's texts are written from; columns it adds may be kept.
Deal = Callable[[DataFrame], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(schema_of(TABLES[name])).parquet(f"{sf_dir}/{name}.parquet")


def ship_month() -> Column:
    return F.trunc(F.col("l_shipdate").cast("date"), "MM")


def sku_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units shipped per item and month."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("key"), ship_month().alias("month"))
        .agg(F.sum("l_quantity").alias("units"))
    )


def spread(
    rows: DataFrame, keys: list[str], name: str, values: list[int], amount: str
) -> DataFrame:
    """Sums of ``amount`` per ``keys``, a column per value of ``name``.

    Only the narrow rows travel, once, gathered by ``keys``. A pivot would send a row of full width per
    key from every task that holds one of its values.
    """
    cells = [F.sum(F.when(F.col(name) == v, F.col(amount))).alias(str(v)) for v in values]
    return rows.repartition(tasks_for(rows), *keys).groupBy(*keys).agg(*cells)


def asin(key: str = "key") -> Column:
    return F.concat(F.lit("A"), F.col(key).cast("string"))


def sku(key: str = "key") -> Column:
    return F.concat(F.lit("S"), F.col(key).cast("string"))


def forecast_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions dated day 8 to 16 of each month, five months ahead, from the month's units."""
    u = F.col("units")
    target = F.add_months("month", F.col("ahead"))
    return sku_month(spark, sf_dir).withColumn(
        "ahead", F.explode(F.sequence(F.lit(1), F.lit(5)))
    ).select(
        F.date_add("month", (F.col("key") % 9 + 7).cast("int")).alias("POS_Fcst_Version_Date"),
        asin().alias("ASIN"),
        F.concat(F.lit("0"), F.col("key").cast("string")).alias("UPC"),
        F.concat(F.lit("Item "), F.col("key").cast("string")).alias("Product_Title"),
        F.month(target).alias("Month_Num"),
        F.date_format(target, "MMMM").alias("Month"),
        F.year(target).alias("Year"),
        u.alias("Mean_Fcst"),
        (u + F.floor(u / 10)).cast("double").alias("P70_Fcst"),
        (u + F.floor(u / 5)).cast("double").alias("P80_Fcst"),
        (u + F.floor(u * 7 / 20)).cast("double").alias("P90_Fcst"),
    )


def actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sku_month(spark, sf_dir).select(
        F.col("month").alias("Date"), asin().alias("ASIN"), F.col("units").alias("Shipped_Units")
    )


# Part type to category; STANDARD has none.
CATEGORY_OF = {
    "ECONOMY": "WATERING",
    "LARGE": "TOTAL SCISSORS",
    "MEDIUM": "COOKING",
    "PROMO": "STRIKING TOOLS",
    "SMALL": "CREATING",
}


def leadtimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lead time, category and sub-category; the largest parts are not listed."""
    category = F.lit(None).cast("string")
    for kind, name in CATEGORY_OF.items():
        category = F.when(F.col("p_type") == kind, F.lit(name)).otherwise(category)
    return table(spark, sf_dir, "part").where(F.col("p_size") < 50).select(
        asin("p_partkey").alias("ASIN"),
        sku("p_partkey").alias("SKU"),
        (F.col("p_size") % 4 + 1).alias("Our_LT"),
        category.alias("Category"),
        F.col("p_brand").alias("Sub_Category"),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand category by size and value class by type, for two customers."""
    size, kind = F.col("p_size"), F.col("p_type")
    demand = (
        F.when(size <= 10, "Smooth").when(size <= 20, "Erratic").when(size <= 30, "Intermittent")
        .when(size <= 40, "Lumpy").when(size <= 45, "New").otherwise("Inactive")
    )
    abc = (
        F.when(kind.isin("ECONOMY", "LARGE"), "A").when(kind.isin("MEDIUM", "PROMO"), "B")
        .when(kind == "SMALL", "C")
    )
    return table(spark, sf_dir, "part").select(
        F.lit(COMPANY).alias("COMPANY"),
        F.explode(F.array(F.lit(CUSTOMER), F.lit("OTHER CUSTOMER"))).alias("CUSTOMER"),
        sku("p_partkey").alias("ITEM_NUMBER"),
        demand.alias("DEMAND_CAT_CU"),
        abc.alias("ABC_REV_ITM_CU"),
    )


# ---- raw report text ----------------------------------------------------------------------------


def report_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units, revenue in cents and row count per item and month."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_partkey").alias("key"), ship_month().alias("month"))
        .agg(
            F.sum("l_quantity").cast("bigint").alias("q"),
            F.sum(F.rint(F.col("l_extendedprice") * 100).cast("bigint")).alias("rev"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def thousands(x: str) -> str:
    """SQL text that writes a whole number with thousands commas."""
    return (
        f"CASE WHEN {x} < 1000 THEN string({x}) "
        f"WHEN {x} < 1000000 THEN concat({x} div 1000, ',', lpad({x} % 1000, 3, '0')) "
        f"ELSE concat({x} div 1000000, ',', lpad({x} div 1000 % 1000, 3, '0'), ',', "
        f"lpad({x} % 1000, 3, '0')) END"
    )


def with_texts(values: DataFrame) -> DataFrame:
    """Texts the cells of a row are put together from."""
    return values.selectExpr(
        "*",
        f"{thousands('(rev div 100)')} AS dollars",
        f"{thousands('(q * 20)')} AS share",
        "lpad(q % 1000, 3, '0') AS tail",
        "IF(n = 2, '($', '$') AS opening",
        "IF(n = 2, ')', '') AS closing",
    )


def report_cell(rule: str, position: int) -> str:
    """SQL text of one report cell from the row's texts and the column's position."""
    if rule == "money":
        cents = f"lpad((rev + {position}) % 100, 2, '0')"
        return f"IF(q = {position}, '—', concat(opening, dollars, '.', {cents}, closing))"
    if rule in ("percent", "plain_percent"):
        return f"concat(share, '.{position % 10}%')"
    if rule == "count":
        return f"concat('{position},', tail)"
    return "IF(q < 25, 'Basic', 'Core')"


def item_columns() -> list[Column]:
    key = F.col("key").cast("string")
    return [
        asin().alias("ASIN"),
        F.concat(F.lit("0"), key).alias("UPC"),
        F.concat(F.lit("Item "), key).alias("Product_Title"),
    ]


def raw_report(
    spark: SparkSession, sf_dir: str, layout: Layout, deal: Deal = lambda values: values,
    kept: Sequence[str] = (),
) -> DataFrame:
    """Monthly report with text cells and the path each row would come from."""
    cells = [
        F.expr(report_cell(layout.rules[c], i)).alias(c)
        for i, c in enumerate(layout.columns)
        if i >= 3
    ]
    path = F.concat(
        F.lit("/drop/Raw/Report With UPC_"), F.date_format("month", "MMMM_yyyy"), F.lit(".csv")
    )
    return with_texts(deal(report_values(spark, sf_dir))).select(
        *item_columns(), *cells, path.alias("Source_File"), *kept
    )


# ---- weekly planning file -----------------------------------------------------------------------


def weekly_raw(
    spark: SparkSession, sf_dir: str, deal: Deal = lambda values: values, kept: Sequence[str] = ()
) -> DataFrame:
    """Weekly files: a row per version and item, 17 planning columns and 104 weekly text cells.

    Every shipment falls into one week of one version, so all of lineitem is used. A week without
    shipments reads 0; weeks with 13 units read as a dash.
    """
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit(FIRST_FILE))
    version = F.date_add(F.lit(FIRST_FILE), (F.floor(days / 182) * 182).cast("int"))
    shipped = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("key"),
        version.alias("File_Date"),
        (F.floor((days % 182) / 7) + 1).cast("int").alias("week"),
        "l_quantity",
    )
    weekly = spread(
        shipped, ["key", "File_Date"], "week", list(range(1, WEEKS + 1)), "l_quantity"
    )
    endings = dict(zip(MEASURES, ("000", "100", "200", "350")))
    units = [f"coalesce(`{w}`, 0)" for w in range(1, WEEKS + 1)]
    # Whole units per week, and the values the planning columns are written from.
    values = deal(weekly).selectExpr(
        "key", "File_Date", *kept, *[f"bigint({u}) AS w{w}" for w, u in enumerate(units, 1)]
    ).selectExpr("*", f"{' + '.join(f'w{w}' for w in range(1, WEEKS + 1))} AS q", "1L AS n")
    values = with_texts(values.selectExpr("*", "q * 700 AS rev"))
    # A week's digits are written once for its four measures.
    values = values.selectExpr("*", *[f"IF(w{w} = 13, NULL, string(w{w})) AS t{w}" for w in range(1, WEEKS + 1)])

    def cell(week: int, measure: str) -> Column:
        text = f"coalesce(concat(t{week}, ',{endings[measure]}'), '—')"
        return F.expr(text).alias(week_column(week, measure))

    plan = [
        F.expr(report_cell(INVENTORY.rules[c], i)).alias(c)
        for i, c in enumerate(INVENTORY.columns)
        if i >= 3
    ]
    weeks = [cell(w, m) for m in MEASURES for w in range(1, WEEKS + 1)]
    return values.select(*item_columns(), *plan, *weeks, "File_Date", *kept)


# ---- demand history -----------------------------------------------------------------------------


def history_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item, an unused column, and one column per month of the calendar."""
    month_no = F.year("l_shipdate") * 12 + F.month("l_shipdate")
    wide = spread(
        table(spark, sf_dir, "lineitem").select(
            sku("l_partkey").alias("Item"), month_no.alias("m"), "l_quantity"
        ),
        ["Item"], "m", [m.year * 12 + m.month for m in MONTHS], "l_quantity",
    )
    return wide.selectExpr(
        "Item",
        "'units' AS Measure",
        *[f"`{m.year * 12 + m.month}` AS `{header_of(m)}`" for m in MONTHS],
    )


def history_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the months in which an item shipped."""
    return sku_month(spark, sf_dir).select(
        sku().alias("SKU"), F.col("month").alias("Date"), F.col("units").alias("History")
    )


# ---- accuracy reports ---------------------------------------------------------------------------


def report_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units and cost per month, country, customer, division and item.

    Rows are dealt out by item and month, which the stat report's pooled divisions share.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", ship_month().alias("month"), "l_linestatus", "l_returnflag", "l_tax",
        "l_quantity", "l_extendedprice",
    )
    return (
        lines.repartition(tasks_for(lines), "l_partkey", "month")
        .groupBy(
            "month",
            F.when(F.col("l_linestatus") == "O", "USA").otherwise("CANADA").alias("Country"),
            F.concat(F.lit("CUST "), F.col("l_returnflag")).alias("Customer"),
            F.when(F.col("l_tax") < 0.04, "GOL").when(F.col("l_tax") < 0.07, "SOC")
            .otherwise("WAT").alias("Division"),
            F.col("l_partkey").alias("key"),
        )
        .agg(
            F.sum("l_quantity").alias("u"),
            F.sum(F.col("l_extendedprice").cast(MONEY)).alias("c"),
        )
    )


def accuracy_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, c = F.col("u"), F.col("c").cast("double")
    return report_grain(spark, sf_dir).select(
        F.year("month").alias("Year"),
        F.upper(F.date_format("month", "MMMM")).alias("Month"),
        "Country",
        sku().alias("SKU Number"),
        (c / u).alias("Cost"),
        "Division",
        "Customer",
        F.floor(u * 9 / 10).cast("double").alias("Adjusted FC - Units"),
        (c * 0.75).alias("Adjusted FC - Cost"),
        u.alias("Adjusted Orders - Units"),
        c.alias("Adjusted Orders - Cost"),
    )


def stat_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stat forecast of the pooled divisions; none under 3 units, unknown over 45."""
    return (
        report_grain(spark, sf_dir)
        .groupBy("month", "Country", "Customer", "key")
        .agg(F.sum("u").alias("u"), F.sum("c").alias("c"))
        .where(F.col("u") >= 3)
        .select(
            F.year("month").alias("Year"),
            F.upper(F.date_format("month", "MMMM")).alias("Month"),
            "Country",
            sku().alias("SKU Number"),
            F.lit("ALL").alias("Division"),
            "Customer",
            F.when(F.col("u") <= 45, F.col("u") * 1.25).alias("Stat Forecast Units"),
            F.when(F.col("u") <= 45, F.col("c").cast("double") * 1.25).alias("Stat Forecast Cost"),
        )
    )


# ---- yearly accuracy sheets of the second unit --------------------------------------------------


def accuracy_source(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    """The years to 1997 in last year's layout, later ones in this year's."""
    ship = F.col("l_shipdate")
    split = F.lit("1998-01-01").cast("timestamp_ntz")
    rows = table(spark, sf_dir, "lineitem").where(
        ship < split if layout == "last_year" else ship >= split
    )
    grain = rows.groupBy(
        ship_month().alias("month"), "l_linestatus", "l_returnflag",
        F.when(F.col("l_linenumber") >= 6, "Yes").otherwise("No").alias("promo"),
        F.col("l_partkey").alias("key"),
    ).agg(
        F.sum("l_quantity").alias("u"),
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("c"),
        F.count(F.lit(1)).alias("n"),
    )
    u, c, n = F.col("u"), F.col("c").cast("double"), F.col("n")
    # Orders fall to zero where one line made the month, so zero bases occur.
    orders = F.when((n == 1) & (u < 5), F.lit(0.0)).otherwise(u)
    fcst = F.floor(u * F.when(F.col("l_returnflag") == "R", 3).otherwise(1) / 2).cast("double")
    names = (
        ("Forecast Cost Corrected", "Order Cost Corrected")
        if layout == "this_year"
        else ("Adjusted Forecast Cost", "Adjusted Order Cost")
    )
    return grain.select(
        F.date_format("month", "yyyy/MMM").alias("Month"),
        F.when(F.col("l_linestatus") == "O", "United States").otherwise("Canada").alias("US/INT"),
        F.col("promo").alias("Promo/NPD?"),
        raw_customer().alias("Customer"),
        F.col("l_returnflag").alias("Category"),
        F.concat(F.col("key").cast("string"), F.lit(" Item "), F.col("key").cast("string")).alias(
            "Item Num/Desc"
        ),
        F.when(n > 1, "several lines").alias("Reason For Adjustment"),
        fcst.alias("Forecast Units"),
        (c * 0.5).alias("Forecast Cost $"),
        orders.alias("Order Units"),
        c.alias("Order Cost $"),
        F.lit(0.0).alias("Forecast Unit Adjustment"),
        fcst.alias("Forecast Units Corrected"),
        F.lit(0.0).alias("Order Unit Adjustment"),
        orders.alias("Order Units Corrected"),
        (c * 0.75).alias(names[0]),
        F.when(orders == 0, F.lit(0.0)).otherwise(c).alias(names[1]),
    )


def raw_customer() -> Column:
    """Spellings that need one name, by return flag and line status."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return (
        F.when((flag == "R") & (status == "O"), " do it best corp ")
        .when(flag == "R", "All Other - (G45)")
        .when((flag == "A") & (status == "O"), "Meijer Inc")
        .when(flag == "A", " All Other - (G45)")
        .when(status == "O", "orgill west\t")
        .otherwise("True Value")
    )


# ---- month end ----------------------------------------------------------------------------------


def month_end_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value per month and month-end key."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderpriority",
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("FC_Date"),
        F.col("o_totalprice").cast(MONEY).alias("price"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "n_name", "r_name")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "c_mktsegment", "o_orderstatus", "o_orderpriority", "FC_Date")
        .agg(F.sum("price").alias("v"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )


def _month_end_keys() -> dict[str, Column]:
    pooled = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    month = F.date_format("FC_Date", "MMMM")
    return {
        "Country": F.col("r_name"),
        "Division": F.col("c_mktsegment"),
        # One nation has no manager, one is a house account, one the pooled name itself.
        "Sales_Manager": F.when(F.col("n_name") == "NATION_1", F.lit(ALL_OTHER))
        .when(F.col("n_name") == "NATION_2", F.lit(HOUSE_ACCOUNTS[0]))
        .when(F.col("n_name") != "NATION_0", F.col("n_name")),
        "Director": F.concat(F.lit("DIRECTOR "), F.col("r_name")),
        "Customer": F.when(pooled, F.lit(ALL_OTHER_CODE)).otherwise(F.col("c_mktsegment")),
        "SRP5": F.col("o_orderpriority"),
        "SRP7": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")),
        "Year": F.year("FC_Date"),
        "Month": month,
        "FC_Date": F.col("FC_Date"),
        "Month_No": F.month("FC_Date"),
    }


def _month_end_tail() -> dict[str, Column]:
    return {
        "Conversion_Rate": F.when(F.col("r_name") == "EUROPE", 0.75).otherwise(1.0),
        "Month_Year": F.lit(None).cast("string"),
        "Key": F.concat("r_name", F.date_format("FC_Date", "MMMMyyyy")),
        "Current_ME_Version": F.when(
            F.col("ME_Version_Date") == F.lit(THIS_VERSION), "Y"
        ).otherwise("N"),
        "Current_Month": F.when(
            F.col("FC_Date") == F.trunc("ME_Version_Date", "MM"), "Y"
        ).otherwise("N"),
    }


def month_end_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both versions; last month's had 90 percent of the value of months still to come."""
    src = month_end_orders(spark, sf_dir).withColumn(
        "ME_Version_Date",
        F.explode(F.array(F.lit(LAST_VERSION), F.lit(THIS_VERSION))),
    )
    old = (F.col("ME_Version_Date") == F.lit(LAST_VERSION)) & (
        F.col("FC_Date") > F.lit(LAST_VERSION)
    )
    v = F.when(old, F.col("v") * F.lit("0.9").cast("decimal(2,1)")).otherwise(F.col("v"))
    v = v.cast("double")
    past = F.col("FC_Date") <= F.col("ME_Version_Date")
    return src.select(
        "ME_Version_Date",
        *[c.alias(n) for n, c in _month_end_keys().items()],
        F.when(past, v).alias("Shipments"),
        F.when(~past, v).alias("Forecast"),
        v.alias("Total_Possible"),
        F.lit(None).cast("double").alias("Delta"),
        F.when(past, v).alias("Actl_TP"),
        v.alias("Actl_TP_Fcst"),
        *[c.alias(n) for n, c in _month_end_tail().items()],
    )


def month_end_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plus of 2 percent on urgent and a minus of 1 percent on high-priority orders."""
    rate = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("0.02").cast("decimal(3,2)")).when(
        F.col("o_orderpriority") == "2-HIGH", F.lit("-0.01").cast("decimal(3,2)")
    )
    src = (
        month_end_orders(spark, sf_dir)
        .withColumn("rate", rate)
        .where(F.col("rate").isNotNull())
        .withColumn(
            "ME_Version_Date", F.explode(F.array(F.lit(LAST_VERSION), F.lit(THIS_VERSION)))
        )
    )
    none = F.lit(None).cast("double")
    keys = _month_end_keys()
    keys["Director"] = F.lit(None).cast("string")
    return src.select(
        "ME_Version_Date",
        *[c.alias(n) for n, c in keys.items()],
        none.alias("Shipments"),
        none.alias("Forecast"),
        none.alias("Total_Possible"),
        (F.col("v") * F.col("rate")).cast("double").alias("Delta"),
        none.alias("Actl_TP"),
        none.alias("Actl_TP_Fcst"),
        *[c.alias(n) for n, c in _month_end_tail().items()],
    )


def at_version(df: DataFrame, version: dt.date) -> DataFrame:
    """What the file of one month held: versions up to it."""
    return df.where(F.col("ME_Version_Date") <= F.lit(version))


def snapshot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier snapshot: one row per type, customer group and month of all years."""
    return (
        month_end_orders(spark, sf_dir)
        .groupBy("c_mktsegment", "r_name", "n_name", "FC_Date")
        .agg(F.sum("v").alias("v"))
        .select(
            F.col("c_mktsegment").alias("Customer"),
            F.col("c_mktsegment").alias("Division"),
            F.col("r_name").alias("Country"),
            F.col("n_name").alias("Sales_Manager"),
            F.month("FC_Date").alias("Month_No"),
            F.year("FC_Date").alias("Year"),
            F.explode(F.array(F.lit("BF"), F.lit("LE"))).alias("Forecast_Type"),
            F.bround("v", 0).cast("double").alias("Forecast_Plus_Delta"),
        )
    )

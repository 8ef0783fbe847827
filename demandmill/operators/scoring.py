"""Scoring of test-set forecasts against orders, beside the sales and stat forecasts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandmill.functions.dates import upper_month_label
from demandmill.functions.rules import EXACT, accuracy, half_even, match_join, percent
from demandmill.session import checkpointed, tasks_for

# Names of the two forecasts every model is compared with.
SALES_FORECAST = "Sales_Forecast"
STAT_FORECAST = "Stat_Forecast"
TEST_SET = "_Test_Set"

SALES, STAT, TEST = "Sales", "Stat", "Test"
KINDS = (SALES, STAT, TEST)
DETAIL_KEYS = ("SKU", "Model", "Month_Year", "Kind")
BASES = ("Units", "Cost")
MEASURES = ("Adj_Orders", "Error", "ABS_Error")
ACTUAL = (
    "SKU", "Month_Year", "Cost", "Adj_FC_Units", "Adj_FC_Cost", "Adj_Orders_Units",
    "Adj_Orders_Cost", "Stat_FC_Units", "Stat_FC_Cost",
)


def accuracy_data(
    report: DataFrame, stat: DataFrame, customer: str, divisions: list[str], country: str
) -> DataFrame:
    """Orders, sales forecast and stat forecast of one customer, country and set of divisions.

    The reports are matched on month, country, customer and item; a pair without partner is left
    out, an unknown stat value is 0. The fixed customer and country also filter the stat report
    before the shuffle, since no other row of it can match. Both are dealt out by the size of their files.
    """
    here = (F.col("Customer") == customer) & (F.col("Country") == country)
    acc = report.where(here & F.col("Division").isin(divisions)).select(
        "Year", "Month", upper_month_label("Month", "Year").alias("Month_Year"), "Country",
        F.col("SKU Number").alias("SKU"),
        half_even("Cost", 2).alias("Cost"),
        "Division", "Customer",
        F.col("Adjusted FC - Units").alias("Adj_FC_Units"),
        half_even(F.col("Adjusted FC - Cost")).alias("Adj_FC_Cost"),
        F.col("Adjusted Orders - Units").alias("Adj_Orders_Units"),
        half_even(F.col("Adjusted Orders - Cost")).alias("Adj_Orders_Cost"),
    )
    other = stat.where(here).select(
        upper_month_label("Month", "Year").alias("Month_Year"), "Country", "Customer",
        F.col("SKU Number").alias("SKU"),
        F.coalesce(half_even(F.col("Stat Forecast Units")), F.lit(0.0)).alias("Stat_FC_Units"),
        F.coalesce(half_even(F.col("Stat Forecast Cost")), F.lit(0.0)).alias("Stat_FC_Cost"),
    )
    keys = ["Month_Year", "Country", "Customer", "SKU"]
    tasks = max(tasks_for(report), tasks_for(stat))
    return match_join(acc, other, [(k, k) for k in keys], how="inner", tasks=tasks)


def scoring_rows(test_set: DataFrame, acc: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per item, model, month and kind of forecast, with errors and accuracies.

    Items without any accuracy data are left out; a month without it keeps its row with unknown
    errors. The accuracy data, itself a join, is written once: it tells known items and gives values.
    Both sides are dealt out to ``tasks`` if given, else to as many as the test set's files ask for.
    """
    tasks = tasks or tasks_for(test_set)
    acc = checkpointed(acc)
    both = ["SKU", "Month_Year"]
    lines = acc.select(*ACTUAL).repartition(tasks, *both)
    joined = _tested(test_set, acc, tasks).repartition(tasks, *both).join(lines, both, "left")
    kinds = F.array(*[_kind(name, *_forecasts(name)) for name in KINDS])
    stacked = joined.select(
        "SKU", "Model", "Month_Year", "Adj_Orders_Units", "Adj_Orders_Cost", F.inline(kinds)
    )
    for basis in BASES:
        orders = F.col(f"Adj_Orders_{basis}")
        stacked = stacked.withColumn(f"Error_{basis}", orders - F.col(f"Fcst_{basis}"))
        stacked = stacked.withColumn(f"ABS_Error_{basis}", F.abs(F.col(f"Error_{basis}")))
        stacked = stacked.withColumn(
            f"Acc_{basis}", percent(accuracy(F.col(f"ABS_Error_{basis}"), orders))
        )
    return stacked


def _tested(test_set: DataFrame, acc: DataFrame, tasks: int) -> DataFrame:
    """Test-set forecasts of the items that the accuracy data holds, both dealt out by item."""
    test = test_set.select(
        "SKU", "Model", F.col("Month").alias("Month_Year"), F.col("Forecast").alias("Test_Units")
    )
    known = acc.select("SKU").repartition(tasks, "SKU")
    return test.repartition(tasks, "SKU").join(known, "SKU", "left_semi")


def scored_sums(test_set: DataFrame, acc: DataFrame, tasks: int | None = None) -> DataFrame:
    """The scored rows summed to item, model, month and kind, for every result but the detail.

    Errors of the sales and stat forecasts do not depend on a model, so they are summed once per item
    and month and put beside each model's own sums afterwards; only the test forecasts are scored line
    by line. Repeated test-set rows count as often as they occur. Grouping and both joins share the
    partitioning by item and month, into ``tasks`` if given, else as many as the test set's files ask for.
    """
    tasks = tasks or tasks_for(test_set)
    acc = checkpointed(acc)
    both = ["SKU", "Month_Year"]
    lines = acc.select(*ACTUAL).repartition(tasks, *both)
    own = (
        _tested(test_set, acc, tasks)
        .repartition(tasks, *both)
        .join(lines, both, "left")
        .select(*both, "Model", *_measures(TEST))
        .groupBy(*both, "Model")
        .agg(_sums_of(TEST).alias(TEST), F.count(F.lit(1)).alias("__rows"))
    )
    shared = (
        lines.select(*both, *_measures(SALES), *_measures(STAT))
        .groupBy(*both)
        .agg(
            _sums_of(SALES).alias(SALES), _sums_of(STAT).alias(STAT),
            F.count(F.lit(1)).alias("__lines"),
        )
    )
    # Each test-set row met every line of its item and month, or none.
    copies = F.expr("int(__rows div greatest(coalesce(__lines, 1), 1))")
    kinds = F.concat(
        F.array(_named(TEST)),
        F.array_repeat(_named(SALES), copies),
        F.array_repeat(_named(STAT), copies),
    )
    return own.join(shared, both, "left").select(
        "SKU", "Model", "Month_Year", F.inline(kinds)
    )


def _forecasts(name: str) -> tuple[Column, Column]:
    """Units and cost of a line under one kind of forecast."""
    if name == TEST:
        return F.col("Test_Units"), half_even(F.col("Test_Units") * F.col("Cost"))
    prefix = {SALES: "Adj_FC", STAT: "Stat_FC"}[name]
    return F.col(f"{prefix}_Units"), F.col(f"{prefix}_Cost")


def _measures(name: str) -> list[Column]:
    """Orders, errors and absolute errors of a line under one kind of forecast."""
    out = []
    for basis, forecast in zip(BASES, _forecasts(name)):
        orders = F.col(f"Adj_Orders_{basis}")
        error = orders - forecast.cast("double")
        out += [
            x.alias(f"{name}_{m}_{basis}") for m, x in zip(MEASURES, (orders, error, F.abs(error)))
        ]
    return out


def _sums_of(name: str) -> Column:
    return F.struct(
        *[
            F.sum(F.col(f"{name}_{m}_{basis}").cast(EXACT)).alias(f"{m}_{basis}")
            for basis in BASES
            for m in MEASURES
        ]
    )


def _named(name: str) -> Column:
    sums = [F.col(name)[f"{m}_{basis}"].alias(f"{m}_{basis}") for basis in BASES for m in MEASURES]
    return F.struct(F.lit(name).alias("Kind"), *sums)


def _kind(name: str, units: Column, cost: Column) -> Column:
    return F.struct(
        F.lit(name).alias("Kind"),
        units.cast("double").alias("Fcst_Units"),
        cost.cast("double").alias("Fcst_Cost"),
    )


def _exact_sums(*names: str) -> list[Column]:
    return [F.sum(F.col(n).cast(EXACT)).alias(n) for n in names]


def _known(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def sku_totals(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Order cost, absolute error cost and accuracy per item, model and kind.

    ``rows`` are scored rows or their sums by ``scored_sums``, here and in ``model_summary``. They are
    dealt out by item to ``tasks`` if given, else to as many as their files ask for, unless they lie so.
    """
    dealt = rows.repartition(tasks or tasks_for(rows), "SKU")
    sums = dealt.groupBy("SKU", "Model", "Kind").agg(
        *_exact_sums("Adj_Orders_Cost", "ABS_Error_Cost")
    )
    orders, error = _known("Adj_Orders_Cost"), _known("ABS_Error_Cost")
    return sums.select(
        "SKU", "Model", "Kind",
        orders.alias("Total_Adj_Orders_Cost"),
        error.alias("Total_ABS_Error_Cost"),
        percent(accuracy(error, orders)).alias("Total_Acc_Cost"),
    )


def scored_name() -> Column:
    """Name under which a kind of forecast is compared: the model, or one of the two others."""
    return (
        F.when(F.col("Kind") == SALES, F.lit(SALES_FORECAST))
        .when(F.col("Kind") == STAT, F.lit(STAT_FORECAST))
        .otherwise(F.concat("Model", F.lit(TEST_SET)))
    )


def model_summary(rows: DataFrame, month_labels: list[str]) -> DataFrame:
    """One row per forecast: accuracy per month and in total, for units and cost, best cost first.

    Monthly sums are made once; the totals are the second grouping set over those sums, and the
    month columns come from an explicit list.
    """
    measures = [
        f"{m}_{basis}" for basis in ("Cost", "Units") for m in ("Adj_Orders", "Error", "ABS_Error")
    ]
    monthly = rows.groupBy("Model", "Kind", "Month_Year").agg(*_exact_sums(*measures))
    keys = [F.col(c) for c in ("Model", "Kind", "Month_Year")]
    sets = monthly.groupingSets([keys, keys[:2]], *keys).agg(
        *[F.sum(m).alias(m) for m in measures], F.grouping("Month_Year").alias("overall")
    )
    slot = F.when(F.col("overall") == 1, F.lit("Total")).otherwise(F.col("Month_Year"))
    cells = []
    for basis in ("Cost", "Units"):
        orders, error = _known(f"Adj_Orders_{basis}"), _known(f"Error_{basis}")
        # A total error is rounded before the total accuracy is taken from it.
        abs_error = F.when(
            F.col("overall") == 1, half_even(_known(f"ABS_Error_{basis}"))
        ).otherwise(_known(f"ABS_Error_{basis}"))
        cells += [
            half_even(error).alias(f"Error_{basis}"),
            abs_error.alias(f"ABS_Error_{basis}"),
            percent(accuracy(abs_error, orders)).alias(f"Acc_{basis}"),
        ]
    scored = sets.select(scored_name().alias("Name"), "Model", slot.alias("Slot"), *cells)
    wide = scored.groupBy("Name", "Model").pivot("Slot", [*month_labels, "Total"]).agg(
        *[F.first(c).alias(c) for c in ("Error_Cost", "ABS_Error_Cost", "Acc_Cost",
                                        "Error_Units", "ABS_Error_Units", "Acc_Units")]
    )
    out = [F.col("Name").alias("Model")]
    for basis in ("Cost", "Units"):
        out.append(F.lit(basis).alias(basis))
        out += [
            F.col(f"{m}_Acc_{basis}").alias(f"{m}_{basis.lower()}") for m in month_labels
        ]
        out += [
            F.col(f"Total_{x}_{basis}").alias(f"Total_{x}_{basis}")
            for x in ("Error", "ABS_Error", "Acc")
        ]
    return wide.select(*out).distinct().orderBy(F.desc("Total_Acc_Cost"), "Model")


def best_model_per_sku(totals: DataFrame, models: list[str]) -> DataFrame:
    """Cost accuracy of every forecast per item, and the name of the best.

    The sales and stat values are those next to the first model. An item for which one value is
    unknown has no best; the smaller name wins a tie.
    """
    first = F.col("Model") == models[0]
    kind, acc = F.col("Kind"), F.col("Total_Acc_Cost")
    stat_name, sales_name = "Stat_Acc_Cost", "Sales_Acc_Cost"
    columns = {
        stat_name: F.max(F.when(first & (kind == STAT), acc)),
        sales_name: F.max(F.when(first & (kind == SALES), acc)),
    }
    for m in models:
        columns[f"{m}{TEST_SET}_Acc_Cost"] = F.max(
            F.when((F.col("Model") == m) & (kind == TEST), acc)
        )
    wide = totals.groupBy("SKU").agg(*[c.alias(n) for n, c in columns.items()])
    names = sorted(columns)
    top = F.greatest(*[F.col(n) for n in names])
    best = F.lit(None).cast("string")
    for n in reversed(names):
        best = F.when(F.col(n) == top, F.lit(n)).otherwise(best)
    all_known = F.lit(True)
    for n in names:
        all_known = all_known & F.col(n).isNotNull()
    return wide.withColumn("Best_Model", F.when(all_known, best))


def excluded_skus(test_set: DataFrame, acc: DataFrame, tasks: int | None = None) -> DataFrame:
    """Items of the test set that the accuracy data does not hold.

    Items of both are dealt out to ``tasks`` if given, else to as many as their files ask for; an unknown
    item is one of them.
    """
    tasks = tasks or max(tasks_for(test_set), tasks_for(acc))
    tested = test_set.select("SKU").repartition(tasks, "SKU").distinct()
    items = tested.withColumn("__tested", F.lit(True)).unionByName(
        acc.select("SKU", F.lit(False).alias("__tested"))
    )
    alone = items.repartition(tasks, "SKU").groupBy("SKU").agg(F.bool_and("__tested").alias("__alone"))
    return alone.where("__alone").select("SKU")


def sku_detail_nested(rows: DataFrame) -> DataFrame:
    """All scored rows of an item, model, month and kind as one array; ``Copies`` counts equal rows.

    Lookup copies can repeat a row any number of times. Equal rows are counted before anything is
    collected, so an array holds only the different rows of one cell.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("Copies"))
    details = [c for c in counted.columns if c not in DETAIL_KEYS]
    return counted.groupBy(*DETAIL_KEYS).agg(
        F.array_sort(F.collect_list(F.struct(*details))).alias("Detail")
    )


class Scores(NamedTuple):
    """Everything a scoring run returns."""

    sku_details: DataFrame
    model_summary: DataFrame
    sku_summary: DataFrame
    excluded_skus: DataFrame


def score(
    test_set: DataFrame, acc: DataFrame, models: list[str], month_labels: list[str]
) -> Scores:
    """The four results of a scoring run; test set, accuracy data and sums are computed once."""
    tasks = tasks_for(test_set)
    test_set, acc = checkpointed(test_set), checkpointed(acc)
    sums = checkpointed(scored_sums(test_set, acc, tasks))
    return Scores(
        sku_detail_nested(scoring_rows(test_set, acc, tasks)),
        model_summary(sums, month_labels),
        best_model_per_sku(sku_totals(sums, tasks), models),
        excluded_skus(test_set, acc, tasks),
    )

"""Mixing sources to target weights: Pareto order sampling under a word budget.

A source's share is its weight's part of the whole budget, at most ``max_copies`` times its words;
what is over goes to the other sources by weight. Inside a source every document is taken
``target / words`` times, times its own weight where one is given: the whole part of that are certain
copies, the rest ``p`` is a chance. Documents are ranked by their random odds ``u / (1 - u)`` divided
by their inclusion odds ``p / (1 - p)``; the sample is the smallest ranks up to the words still
wanted, so its size is fixed and each inclusion has about its chance. ``u`` is a hash of the whole row
and the seed: reruns agree. Equal rows are counted and numbered, and the number is part of the hash, so
some of them are taken more often than others and a sample's size holds whatever repeats.

The cut in a source is found without sorting it: words are summed by rank in 1024 bins, then in 1024
parts of the bin where the budget ends, and only that part is ranked row by row. A hot source is
therefore summed in parallel. Afterwards each row's copies follow from its own id and its source's
cut, without a shuffle of texts.

Null text has size 0, is in no sample, and is listed; a source without words has target 0. Null is a
source, last in order. Rows that share a ``doc_id``, or have none, are drawn each for itself. A text of
any length counts whole, in SQL functions. The windows over sources hold a row per source. Columns that
hold maps are not part of a row's hash. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandmill.llm.common import SPACE, whole_row
from demandmill.session import checkpointed

WEIGHTS = (3, 1, 2)
BUDGET, MAX_COPIES, SEED = 1.5, 2, 9
BINS = 1024
#: A table of sources up to this many rows is broadcast (about 100 bytes each).
BROADCAST_SOURCES = 20_000
#: Repeated rows up to this many (40 bytes each) are broadcast; copies that are made at once.
BROADCAST_ROWS, PART = 200_000, 4096


def word_count(text: Column | str = "text") -> Column:
    """Runs of characters other than white space; null has none."""
    column = F.col(text) if isinstance(text, str) else text
    parts = F.split(column, SPACE)
    outer = (F.element_at(parts, 1) == "").cast("int") + (
        (F.element_at(parts, -1) == "") & (F.size(parts) > 1)
    ).cast("int")
    return F.coalesce(F.size(parts) - outer, F.lit(0)).cast("long")


def _unit(nth: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the row and its number among equal rows."""
    mixed = F.xxhash64("__g", "__h", nth.cast("long"), F.lit(seed))
    return ((F.shiftrightunsigned(mixed, 11) + F.lit(0.5)) / float(1 << 53)).alias("__u")


def _identity(docs: DataFrame) -> list[Column]:
    """128 bits of hash over a row."""
    columns = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    return [F.xxhash64(*columns).alias("__g"), F.xxhash64(F.lit(1), *columns).alias("__h")]


def _numbered(rows: DataFrame, *columns: Column | str) -> DataFrame:
    """A row for each of the ``n`` copies a row stands for, with ``__nth`` from 0.

    Copies of a row are made in parts of ``PART``, which are dealt out first.
    """
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / PART))).alias("__part")
    parts = rows.select("*", part).repartition("__g", "__h", "__part")
    end = F.least(F.col("n"), (F.col("__part") + 1) * PART) - 1
    nth = F.explode(F.sequence(F.col("__part") * PART, end)).alias("__nth")
    return parts.select("*", nth).drop("__part").select(*columns, "__nth")


def targets(
    sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """``sources`` (``source, source_size``) with ``target``.

    Filling up: in the order of limit over weight, a source is at its limit as long as that lies under
    the level ``(budget left) / (weight left)``; the others share what is left by weight. The windows
    run over one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.isnull("source"), "source")) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")
    )
    rows = sources.select("*", weight.alias("__w")).select(
        "*", (F.col("source_size") * float(max_copies)).alias("__limit")
    )
    by_limit = Window.orderBy(F.col("__limit") / F.col("__w"), F.isnull("source"), "source")
    upto, whole = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = budget * F.sum("source_size").over(whole) - F.coalesce(F.sum("__limit").over(upto), F.lit(0.0))
    weight_left = F.sum("__w").over(whole) - F.coalesce(F.sum("__w").over(upto), F.lit(0.0))
    rows = rows.select("*", (left / weight_left).alias("__level")).select(
        "*", (F.col("__limit") <= F.col("__level") * F.col("__w")).alias("__full")
    )
    # The first source that is not full sets the level of all from there on.
    level = F.min(F.when(~F.col("__full"), F.struct(F.col("__limit") / F.col("__w"), "__level")))
    rows = rows.select("*", level.over(whole)["__level"].alias("__share"))
    return rows.select(
        "source", "source_size",
        F.when(F.col("__full"), F.col("__limit"))
        .otherwise(F.least(F.col("__limit"), F.col("__share") * F.col("__w")))
        .alias("target"),
    )


def _beside(rows: DataFrame, per_source: DataFrame, known: int) -> DataFrame:
    """Join a per-source table; beyond the checked size Spark joins (and splits hot sources) itself."""
    other = per_source.withColumnRenamed("source", "__other")
    if known <= BROADCAST_SOURCES:
        other = F.broadcast(other)
    return rows.join(other, rows["source"].eqNullSafe(F.col("__other"))).drop("__other")


def _copies(max_copies: int) -> list[Column]:
    """Certain copies, and the rank: odds over odds, folded into (0, 1]."""
    wanted = F.least(F.lit(float(max_copies)), F.col("target") * F.col("weight") / F.col("mass"))
    wanted = F.when(F.col("mass") > 0, wanted).otherwise(0.0)
    whole = F.floor(wanted)
    chance = wanted - whole
    u = F.col("__u")
    # u/(1-u) over p/(1-p), as q/(1+q); 1 where there is no chance left.
    rank = F.when(chance > 0, u * (1 - chance) / (u * (1 - chance) + (1 - u) * chance)).otherwise(1.0)
    return [whole.cast("long").alias("whole"), rank.alias("rank")]


def _cut(rows: DataFrame, known: int) -> DataFrame:
    """``source, cut_rank, cut_id``: rows up to there (by rank, then id) are in the sample.

    A row is in when the middle of its words lies within the words wanted: the nearest sum.
    """
    rows = rows.where("size > 0 AND rank < 1")
    start = F.lit(0.0)
    per_source = rows.groupBy("source").agg(F.first("wanted").alias("wanted"))
    per_source = per_source.select("source", "wanted", start.alias("low"), start.alias("before"))
    width = 1.0
    for _ in range(2):
        width /= BINS
        inside = _beside(rows.drop("wanted"), per_source, known).where(
            (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("low") + width * BINS)
        )
        bins = inside.groupBy("source", F.floor((F.col("rank") - F.col("low")) / width).alias("bin")).agg(
            F.sum("size").alias("words"), F.first("wanted").alias("wanted"),
            F.first("low").alias("low"), F.first("before").alias("before"),
        )
        order = Window.partitionBy("source").orderBy("bin")
        upto = F.sum("words").over(order) + F.col("before")
        last = F.lead("bin").over(order).isNull()
        ends = bins.select(
            "source", "wanted", (F.col("low") + F.col("bin") * width).alias("low"),
            (upto - F.col("words")).alias("before"), upto.alias("upto"), last.alias("last"),
        ).where("before <= wanted AND (upto > wanted OR last)")
        # Two bins meet the condition only where one ends just at the budget: the first will do.
        per_source = checkpointed(
            ends.groupBy("source").agg(F.min(F.struct("low", "wanted", "before")).alias("e"))
            .select("source", "e.wanted", "e.low", "e.before")
        )
    inside = _beside(rows.drop("wanted"), per_source, known).where(
        (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("low") + width)
    )
    same = inside.groupBy("source", "rank", "doc_id", "wanted", "before").agg(F.sum("size").alias("size"))
    order = Window.partitionBy("source").orderBy("rank", F.col("doc_id").asc_nulls_first())
    upto = F.sum("size").over(order) + F.col("before")
    found = (
        same.select("source", "rank", "doc_id", (upto - F.col("size") / 2 <= F.col("wanted")).alias("in"))
        .where("in")
        .groupBy("source")
        .agg(F.max(F.struct("rank", F.col("doc_id"))).alias("cut"))
    )
    low = per_source.select("source", F.col("low").alias("__low"))
    return _beside(found.select("source", "cut"), low, known).select(
        "source", F.col("cut.rank").alias("cut_rank"), F.col("cut.doc_id").alias("cut_id")
    ).unionByName(
        low.join(found.select(F.col("source").alias("__s")), F.col("source").eqNullSafe(F.col("__s")), "left_anti")
        .select("source", F.col("__low").alias("cut_rank"), F.lit(None).cast("long").alias("cut_id"))
    )


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET,
    max_copies: int = MAX_COPIES, seed: int = SEED, weight: Column | None = None,
) -> DataFrame:
    """``__row`` (the row of ``docs``), ``size, source_size, target, copies`` for every row.

    ``weight`` makes documents of a source more or less likely to be taken.
    """
    weight = F.lit(1.0) if weight is None else weight
    own = ["doc_id", "source", word_count().alias("size"), weight.cast("double").alias("weight"), *_identity(docs)]
    kinds = docs.select(*own).groupBy("doc_id", "source", "size", "weight", "__g", "__h").agg(
        F.count(F.lit(1)).alias("n")
    )
    kinds = checkpointed(kinds)
    sums = kinds.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum(F.col("size") * F.col("weight") * F.col("n")).alias("mass"),
    )
    sums = checkpointed(sums)
    known = sums.count()
    shares = targets(sums.select("source", "source_size"), weights, budget, max_copies)
    plan = checkpointed(
        sums.select(F.col("source").alias("__s"), "mass")
        .join(shares, F.col("__s").eqNullSafe(F.col("source")))
        .select("source", "source_size", "mass", "target")
    )
    columns = ["source", "doc_id", "size", "weight", "__g", "__h"]
    several = checkpointed(_numbered(kinds.where("n > 1"), *columns))
    single = kinds.where("n = 1").select(*columns, F.lit(0).cast("long").alias("__nth"))
    drawn = single.unionByName(several).select("source", "doc_id", "size", "weight", _unit(F.col("__nth"), seed))
    ranked = _beside(drawn, plan, known).select("source", "doc_id", "size", "target", *_copies(max_copies))
    certain = ranked.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("size") * F.col("whole"))).alias("wanted")
    )
    ranked = _beside(ranked.select("source", "doc_id", "size", "rank"), certain, known)
    cut = checkpointed(_cut(checkpointed(ranked), known))
    plan = _beside(plan, cut, known).unionByName(
        plan.join(cut.select(F.col("source").alias("__s")), F.col("source").eqNullSafe(F.col("__s")), "left_anti"),
        allowMissingColumns=True,
    )
    plan = checkpointed(plan)
    chosen = (F.col("rank") < F.col("cut_rank")) | (
        (F.col("rank") == F.col("cut_rank"))
        & (F.col("doc_id").isNull() | (F.col("doc_id") <= F.col("cut_id")))
        & F.col("cut_id").isNotNull()
    )
    extra = F.coalesce((F.col("rank") < 1) & chosen, F.lit(False)).cast("long")
    out = ["__row", "size", "source_size", "target"]
    rows = docs.select(whole_row(docs), *own)
    repeats = several.select("__g", "__h").distinct()
    n_repeats = repeats.count()
    if not n_repeats:
        rows = rows.select("*", _unit(F.lit(0), seed))
        return _beside(rows, plan, known).select("*", *_copies(max_copies)).select(
            *out, (F.col("whole") + extra).alias("copies")
        )
    small = F.broadcast if n_repeats <= BROADCAST_ROWS else lambda df: df
    alone = rows.join(small(repeats), ["__g", "__h"], "left_anti").select("*", _unit(F.lit(0), seed))
    alone = _beside(alone, plan, known).select("*", *_copies(max_copies)).select(
        *out, (F.col("whole") + extra).alias("copies")
    )
    # One row of each group of equal rows, and how many of its numbers were drawn once more.
    groups = _beside(several.select("*", _unit(F.col("__nth"), seed)), plan, known).select(
        "*", *_copies(max_copies)
    ).groupBy("__g", "__h").agg(
        F.count(F.lit(1)).alias("n"), F.first("whole").alias("whole"), F.sum(extra).alias("extra"),
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
    )
    ones = rows.join(small(repeats), ["__g", "__h"], "left_semi").groupBy("__g", "__h").agg(
        F.first("__row").alias("__row"), F.first("size").alias("size")
    )
    copies = F.col("whole") + (F.col("__nth") < F.col("extra")).cast("long")
    again = _numbered(ones.join(groups, ["__g", "__h"]), *out, "whole", "extra").select(*out, copies.alias("copies"))
    return alone.unionByName(again)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with its columns."""
    taken = mix(docs, **options).where("copies > 0")
    return taken.select("__row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("__row.*")

"""Document fingerprints: one-permutation MinHash with optimal densification, in SQL functions only.

Every shingle of five words (fewer words: all of them; white space ``[\\x20\\x09-\\x0D]`` separates words,
case counts) is hashed once. The top eight bits of its hash choose one of 256 bins, the rest is its value;
a bin keeps the smallest. An empty bin takes the value of a filled one: each bin has its own fixed order
of all bins, and takes the first in that order that is filled, so two texts choose alike. Of every bin the
low eight bits are stored, eight bins to a 64-bit word, as 512 hex digits.

Two fingerprints agree by chance in one bin of 256, so with a share m of equal bins the likeness is
(m - c) / (1 - c), c = 1/256, not under 0.

``sort_array`` does the binning: a sentinel per bin makes the first value of each run of one bin the
bin's minimum, or the sentinel where the bin is empty.

Null counts as empty. A text without words has one shingle, the empty one, so empty texts are alike.
Equal texts have equal fingerprints, whatever their other columns hold.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandmill.llm.common import SPACE

SHINGLE = 5
BINS, BITS, LANES = 256, 8, 8
CHANCE = 1 / (1 << BITS)
PROBES = 16
EMPTY = (1 << 56) - 1
#: A bucket of neighbouring ids is sorted in one task; their number bounds the table of their heads.
BUCKET_ROWS, MAX_BUCKETS, RANGES = 1000, 1 << 16, 256


def _mixed(n: int) -> int:
    """A well mixed 64-bit number per bin (the finaliser of splitmix64)."""
    x = (n + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
    x = (x ^ x >> 27) * 0x94D049BB133111EB % (1 << 64)
    return x ^ x >> 31


#: Bin i looks at the bins ``FIRST[i] + t * STEP[i]``, t = 0, 1, ...: all of them, as the step is odd.
FIRST = [_mixed(i) % BINS for i in range(BINS)]
STEP = [_mixed(i + BINS) % BINS | 1 for i in range(BINS)]
BACK = [pow(s, -1, BINS) for s in STEP]


def _numbers(values: list[int], kind: str = "int") -> Column:
    return F.array(*[F.lit(v).cast(kind) for v in values])


def _filled(value: Column) -> Column:
    return value.bitwiseAND(F.lit(EMPTY)) != EMPTY


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """Hashes of ``size`` word hashes in a row; places past the end are null and add nothing."""
    last = F.greatest(F.size(words) - size, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)])
    )


def with_fingerprint(df: DataFrame, text: str, name: str, size: int = SHINGLE) -> DataFrame:
    """``df`` with ``name``: the packed bins of ``text`` as an array of 64-bit words.

    Each step is a column, so that nothing is computed once per element.
    """
    # A bin's number is the signed top byte, so bins come in the order -128 .. 127.
    sentinels = _numbers([(b << 56) + EMPTY for b in range(-BINS // 2, BINS // 2)], "long")
    white = "\x20\x09\x0a\x0b\x0c\x0d"
    step = f"__{name}"
    words = F.split(F.btrim(F.col(text), F.lit(white)), SPACE)
    df = df.withColumn(step, F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn(step, F.sort_array(F.concat(shingle_hashes(F.col(step), size), sentinels)))
    values = F.col(step)
    first_of_bin = lambda x, i: (i == 0) | (
        F.shiftright(x, 56) != F.shiftright(F.get(values, i - 1), 56)
    )
    df = df.withColumn(step, F.filter(values, first_of_bin))
    df = df.withColumn(step, F.transform(values, lambda x: F.when(_filled(x), x.bitwiseAND(F.lit(255)))))
    places = _numbers(list(range(BINS)))
    full = F.filter(places, lambda j: F.get(values, j).isNotNull())
    df = df.withColumn(f"{step}_full", full)
    df = df.withColumn(step, F.transform(values, _densified(values, F.col(f"{step}_full"))))
    low = lambda k, b: F.shiftleft(
        F.get(values, k * LANES + b), b * BITS
    )

    def packed(k: Column) -> Column:
        out = low(k, 0)
        for b in range(1, LANES):
            out = out.bitwiseOR(low(k, b))
        return out

    words = F.transform(F.sequence(F.lit(0), F.lit(BINS // LANES - 1)), packed)
    return df.withColumn(name, words).drop(step, f"{step}_full")


def _densified(bins: Column, full: Column) -> Callable[[Column, Column], Column]:
    """A bin's own value or that of the first filled bin (not null) in its order.

    The first places are looked up one by one, which nearly always ends there for texts that fill many
    bins; else the filled bins, few then, are ranked by their place in the order.
    """
    first, back = _numbers(FIRST), _numbers(BACK)
    orders = [_numbers([(FIRST[i] + t * STEP[i]) % BINS for i in range(BINS)]) for t in range(PROBES)]

    def value(x: Column, i: Column) -> Column:
        place = lambda j: ((j - F.get(first, i)) * F.get(back, i)).bitwiseAND(F.lit(BINS - 1))
        nearest = F.array_min(F.transform(full, lambda j: place(j) * BINS + j))
        return F.coalesce(
            x, *[F.get(bins, F.get(order, i)) for order in orders],
            F.get(bins, nearest.bitwiseAND(F.lit(BINS - 1))),
        )

    return value


def hex_digits(words: Column) -> Column:
    return F.lower(F.concat_ws("", F.transform(words, lambda w: F.lpad(F.hex(w), 16, "0"))))


def likeness(left: Column, right: Column) -> Column:
    """Estimated Jaccard similarity of two packed fingerprints, corrected for chance agreement.

    The number of equal bins: the bytes of the exclusive-or that are zero.
    """
    ones = F.lit(0x0101010101010101)

    def unequal(a: Column, b: Column) -> Column:
        x = a.bitwiseXOR(b)
        for shift in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        return F.bit_count(x.bitwiseAND(ones)).cast("int")

    apart = F.aggregate(F.zip_with(left, right, unequal), F.lit(0), lambda total, x: total + x)
    agree = 1 - apart / F.lit(float(BINS))
    return F.greatest(F.lit(0.0), (agree - CHANCE) / (1 - CHANCE))


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint``, a row per row of ``docs``."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_fingerprint(rows, "text", "fp", size).select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"))


# ---- neighbours by id ---------------------------------------------------------------------------


def _bucket(docs: DataFrame) -> Column | None:
    """Number of the bucket of a row, rising with ``doc_id``; rows without an id are in -1.

    Quantiles cut the ids into ranges of about equal rows, each range into parts of equal width.
    """
    shares = [i / RANGES for i in range(1, RANGES)]
    found = docs.agg(
        F.count("doc_id").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 10_000).alias("cuts"),
    ).first()
    if not found.n:
        return F.lit(-1)
    buckets = min(math.ceil(found.n / BUCKET_ROWS), MAX_BUCKETS)
    starts = sorted({found.low, *found.cuts[:: math.ceil(RANGES / buckets)]})
    # The last range ends with the largest id there can be, at most.
    ends = [*starts[1:], min(found.high + 1, (1 << 63) - 1)]
    parts = max(1, buckets // len(starts))
    doc_id = F.col("doc_id")
    nth = F.size(F.filter(_numbers(starts, "long"), lambda s: s <= doc_id)) - 1
    low = F.get(_numbers(starts, "long"), nth).cast("double")
    width = F.greatest(F.get(_numbers(ends, "long"), nth).cast("double") - low, F.lit(1.0))
    part = F.least(F.lit(parts - 1), F.floor((doc_id.cast("double") - low) / width * parts))
    return F.when(doc_id.isNull(), F.lit(-1)).otherwise(nth * parts + part).cast("int")


def with_copies(rows: DataFrame) -> tuple[DataFrame, Window]:
    """``rows`` (``doc_id, text``) with ``__bucket`` and copies (``__copy``), and the order in which
    ``lead`` finds the next row by descending ``doc_id``; after the last comes the first.

    Null ids come last; rows that share an id go by text. Ids lie in buckets by range, one sorted group
    each. What follows a bucket's last row is the first row of the next bucket, which is copied into it:
    the first ids are known from the ids alone, one per bucket, at most ``MAX_BUCKETS``, and are
    broadcast to find their texts.
    """
    rows = rows.withColumn("__bucket", _bucket(rows))
    heads = rows.groupBy("__bucket").agg(F.max("doc_id").alias("__head"))
    down = Window.orderBy(F.desc("__bucket"))
    head = F.struct("__bucket", "__head")
    following = heads.select(
        F.col("__bucket").alias("__into"),
        F.coalesce(F.lead(head).over(down), F.first(head).over(down)).alias("__from"),
    ).select("__into", F.col("__from.__bucket").alias("__from"), F.col("__from.__head").alias("__head"))
    copies = (
        rows.join(
            F.broadcast(following),
            (F.col("__from") == F.col("__bucket")) & F.col("doc_id").eqNullSafe(F.col("__head")),
        )
        .groupBy("__into")
        .agg(F.min("text").alias("text"))
        .select(
            F.lit(None).cast("long").alias("doc_id"), "text",
            F.col("__into").alias("__bucket"), F.lit(True).alias("__copy"),
        )
    )
    both = rows.withColumn("__copy", F.lit(False)).unionByName(copies)
    by_id = Window.partitionBy("__bucket").orderBy("__copy", F.col("doc_id").desc_nulls_last(), "text")
    return both, by_id


def edited_fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    The edited text has its last half (rounded down) replaced by the start of the next text. Columns:
    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both, by_id = with_copies(rows)
    both = with_fingerprint(both, "text", "fp", size)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = (
        both.withColumn("__next", F.lead(F.struct("text", "fp")).over(by_id))
        .where("not __copy")
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .select(
            "doc_id", "n_chars", "fp", F.col("__next.fp").alias("next_fp"),
            F.concat(
                F.substr("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                F.substr("__next.text", F.lit(1), half),
            ).alias("edited"),
        )
    )
    return with_fingerprint(edited, "edited", "edited_fp", size).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        hex_digits(F.col("fp")).alias("fingerprint"),
        hex_digits(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )

"""SimHash near-dedup: exact comparison of fingerprints in tiles.

Fingerprint: XXH64 (seed 42) of every word shingle, repeats included; a bit is set if it is set in
over half of the hashes. Two fingerprints link at ``radius`` or fewer differing bits.

Equal fingerprints become one row first, so a group of copies of any size is one row. Rows are dealt
out by blocks of bits: of radius + 2 blocks, two at least are equal in a linked pair, so pairs meet in
the group of those two blocks and no row meets all others. Inside, rows lie in order of population
count and are compared tile by tile with numpy's exclusive-or and bit counts; a tile pair whose
population counts differ beyond the radius is skipped. A task sends on a spanning forest of the links
it finds, never all pairs, and the components come from star contraction over Spark joins.

Null text counts as empty. A text without words has fingerprint zero and links like any other. Rows
that share a ``doc_id`` are each given a result; a null ``doc_id`` never names a component unless all
its rows have none (then ``component_id`` is null). Other columns do not matter. An empty table gives
no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandmill.llm.common import LOWER, map_arrow, texts_of, whole_row, with_columns_after
from demandmill.session import checkpointed, shared_dir

SHINGLE, RADIUS, SEED = 3, 2, 42
TILE = 256
#: Hashes of up to so many rows (16 bytes each) may be broadcast.
BROADCAST_ROWS = 500_000


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle; fewer words than ``size`` are one shingle, none give no hash."""
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-size] + 1].tolist()
    digest = xxhash.xxh64_intdigest
    shingles = zip(starts, ends[size - 1 :].tolist())
    return np.array([digest(joined[a:b], SEED) for a, b in shingles], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Majority bits. Bit counts are added eight at a time, as bytes of 64-bit words."""
    n = len(hashes)
    if n == 0:
        return 0
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    lanes = bits.view(np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 255):
        counts += lanes[at : at + 255].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(t, size)) for t in texts_of(batch)]
            if "text" in batch.schema.names:
                batch = batch.drop_columns("text")
            fps = np.array(found, np.uint64).view(np.int64)
            yield batch.append_column("fp", pa.array(fps, pa.int64()))

    return run


def fingerprints(rows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``fp``, the 64 bits as a signed long, after ``rows`` (with ``text``, which goes, or ``__row``)."""
    schema = with_columns_after(rows.drop("text").schema, "fp long")
    return map_arrow(rows, _fingerprints(shingle), schema)


def block_keys(fp: Column, radius: int) -> Column:
    """A key per pair of the radius + 2 blocks that the 64 bits are cut into."""
    cuts = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [
        F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
        for a, b in zip(cuts, cuts[1:])
    ]
    pairs = combinations(range(len(blocks)), 2)
    return F.array(
        *[
            F.struct(F.lit(n).alias("pair"), blocks[i].alias("a"), blocks[j].alias("b"))
            for n, (i, j) in enumerate(pairs)
        ]
    )


def _find(parent: np.ndarray, at: np.ndarray) -> np.ndarray:
    while True:
        up = parent[at]
        if np.array_equal(up, at):
            return at
        at = up


def _unite(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Put the trees of both sides of every link together."""
    while len(left):
        a, b = _find(parent, left), _find(parent, right)
        apart = a != b
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def tile_links(
    group: np.ndarray, pops: np.ndarray, fps: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links ``(row, root)`` of rows ordered by group and population count."""
    n = len(fps)
    parent = np.arange(n)
    for a in range(0, n, TILE):
        a_end = min(a + TILE, n)
        for b in range(a, n, TILE):
            if group[b] != group[a_end - 1] and b != a:
                break
            if b != a and pops[b] - pops[a_end - 1] > radius:
                break
            b_end = min(b + TILE, n)
            near = np.bitwise_count(fps[a:a_end, None] ^ fps[None, b:b_end]) <= radius
            near &= group[a:a_end, None] == group[None, b:b_end]
            i, j = np.nonzero(near)
            up = i + a < j + b
            _unite(parent, i[up] + a, j[up] + b)
    root = _find(parent, parent)
    rows = np.flatnonzero(root != np.arange(n))
    return rows, root[rows]


def _linked(radius: int):
    """Links among sorted rows ``pair, a, b, pop, fp``; a group may run over batches."""

    def links(held: list[np.ndarray]) -> pa.RecordBatch | None:
        rows = np.concatenate(held)
        new = np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)]
        group = np.cumsum(new)
        crowd = np.bincount(group)[group] > 1
        rows, group = rows[crowd], group[crowd]
        at, root = tile_links(group, rows[:, 3], rows[:, 4].view(np.uint64), radius)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[at, 4]), pa.array(rows[root, 4])], ["u", "v"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([c.to_numpy().astype(np.int64) for c in batch.columns])
            last = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0
            if cut or (held and (held[-1][-1, :3] != rows[0, :3]).any()):
                yield links([*held, rows[:cut]])
                held = []
            held.append(rows[cut:])
        if held:
            yield links(held)

    return run


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``u, v``: links between distinct ``fp`` of ``nodes`` that connect all within ``radius``."""
    rows = nodes.select("fp", F.bit_count("fp").alias("pop"), F.explode(block_keys(F.col("fp"), radius)))
    rows = (
        rows.select("col.pair", "col.a", "col.b", "pop", "fp")
        .repartition("pair", "a", "b")
        .sortWithinPartitions("pair", "a", "b", "pop", "fp")
    )
    return map_arrow(rows, _linked(radius), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``u, root``: the smallest node of each linked node's component.

    Alternating large and small stars: every round ties nodes to the smallest neighbour known, and a
    node's edges are only joined with one minimum. Each round is checkpointed; the rounds grow with
    the logarithm of the longest chain.
    """
    edges = checkpointed(
        edges.where("u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(
                F.array(
                    F.struct("u", F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        edges = checkpointed(small.select("e.u", "e.v").where("u != v").distinct())
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == state:
            return edges.select("u", F.col("v").alias("root"))
        state = now


def _classes(rows: DataFrame, radius: int) -> DataFrame:
    """``fp, component_id, first_fp`` for the distinct ``fp`` of ``rows`` (``doc_id, fp``).

    ``first_fp`` is the fingerprint of the row that the component is named after.
    """
    nodes = checkpointed(
        rows.groupBy("fp").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "fp")).alias("first"))
    )
    roots = checkpointed(components(links(nodes, radius)))
    known = roots.unionByName(roots.select(F.col("root").alias("u"), "root")).distinct()
    linked = known.join(nodes, known.u == nodes.fp).select("fp", "root", "first")
    named = linked.groupBy("root").agg(F.min("first").alias("named"))
    linked = linked.join(named, "root").select("fp", "named")
    return nodes.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("named", "first")["doc_id"].alias("component_id"),
        F.coalesce("named", "first")["fp"].alias("first_fp"),
    )


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """``doc_id, fingerprint, component_id``, a row per row of ``docs``."""
    rows = checkpointed(fingerprints(docs.select("doc_id", "text"), shingle))
    # Written, so that both sides of the join are dealt for it alone: Spark then splits a hot fingerprint.
    classes = checkpointed(_classes(rows, radius))
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest ``doc_id``.

    Of rows that share it, the first by fingerprint and then by a hash of all columns stays; of equal
    rows one. Rows are written with their fingerprints once; which go is decided on ids and hashes alone,
    and only these move: a hot fingerprint shuffles as numbers, never as texts.
    """
    path = f"{shared_dir(docs.sparkSession)}/near-copies-{uuid.uuid4().hex}"
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))
    fingerprints(docs.select(whole_row(docs), key.alias("__key")), shingle).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    narrow = rows.select(F.col("__row.doc_id").alias("doc_id"), "fp", "__key")
    named = checkpointed(_classes(narrow, radius)).where("fp = first_fp").select("fp")
    first = F.struct(F.isnull("doc_id"), F.col("doc_id"), F.col("__key").alias("key"))
    best = narrow.groupBy("fp").agg(F.min(first).alias("best")).join(named, "fp", "left_semi")
    best = best.select(F.col("best.key").alias("__key"), F.lit(True).alias("stays"))
    sums = narrow.groupBy("__key").agg(F.count(F.lit(1)).alias("n")).join(best, "__key", "left")
    # Rows that do not simply stay: those that go, and of those that stay the repeated ones.
    marked = checkpointed(sums.where("stays IS NULL OR n > 1"))
    counts = marked.agg(F.count(F.lit(1)).alias("all"), F.count("stays").alias("repeated")).first()
    small = F.broadcast if counts["all"] <= BROADCAST_ROWS else lambda df: df
    kept = rows.join(small(marked.select("__key")), "__key", "left_anti").select("__row.*")
    if not counts["repeated"]:
        return kept
    repeated = rows.join(small(marked.where("stays").select("__key")), "__key", "left_semi")
    once = repeated.groupBy("__key").agg(F.first("__row").alias("__row"))
    return kept.unionByName(once.select("__row.*"))

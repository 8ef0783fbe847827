"""Exact dedup: a two-pass Bloom filter keeps rows that cannot repeat out of the shuffle.

Pass one sets each row's filter bits and notes the bits that were set more than once. Pass two asks
for each row whether all its bits were: only then can its text occur twice, and only those rows
shuffle, to be grouped by their SHA-256. A false positive costs a shuffled row and changes no result.

Bits are counted as Spark rows, one row per task and 65,536-bit chunk with the positions set there,
so the work of building the filter follows the input and no task holds all of it. The finished filter
of repeated bits is broadcast; ``max_filter_bits`` bounds it (128 MiB), and past about 67 million rows
a higher share of false positives shuffles instead of a larger filter.

Texts are equal when identical after white space ``[\\x20\\x09-\\x0D]`` is deleted. Null counts as
empty. Of equal texts the row with the most code points stays, then the smallest ``doc_id`` (null
last); of rows equal in all this, one. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandmill.llm.common import map_arrow, texts_of, whole_row, with_columns_after
from demandmill.session import checkpointed

WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Filter bits per row, hash positions per row.
BITS_PER_ROW, PROBES = 16, 3
MIN_FILTER_BITS, MAX_FILTER_BITS = 1 << 16, 1 << 30
CHUNK = 16
#: Positions that a task holds before it sends them on.
HELD = 1 << 22


def digest(text: bytes) -> bytes:
    return hashlib.sha256(text.translate(None, WHITE)).digest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text_sha256`` comes after the other columns; a plain text column goes."""
    for batch in batches:
        shas = pa.array([digest(t).hex() for t in texts_of(batch)], pa.string())
        if "text" in batch.schema.names:
            batch = batch.drop_columns("text")
        yield batch.append_column("text_sha256", shas)


def positions(shas: list[str], bits: int) -> np.ndarray:
    """Filter positions, one row per hash: double hashing over the digest's first 16 bytes."""
    raw = np.frombuffer(bytes.fromhex("".join(s[:32] for s in shas)), ">u8").reshape(-1, 2)
    raw = raw.astype(np.uint64)
    steps = np.arange(PROBES, dtype=np.uint64)
    places = raw[:, :1] + steps * (raw[:, 1:] | np.uint64(1))
    return (places & np.uint64(bits - 1)).astype(np.int64)


def _set_bits(bits: int):
    """Rows ``chunk, once, often``: low 16 bits of the positions set once, or oftener, by a task."""

    def chunks(held: list[np.ndarray]) -> pa.RecordBatch:
        place, count = np.unique(np.concatenate(held), return_counts=True)
        chunk, low = place >> CHUNK, (place & 0xFFFF).astype("<u2")
        cut = np.flatnonzero(np.diff(chunk)) + 1
        lows, often = np.split(low, cut), np.split(count > 1, cut)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(chunk[np.r_[0, cut]], pa.int64()),
                pa.array([x[~m].tobytes() for x, m in zip(lows, often)], pa.binary()),
                pa.array([x[m].tobytes() for x, m in zip(lows, often)], pa.binary()),
            ],
            ["chunk", "once", "often"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if batch.num_rows:
                # A row's own positions may meet; they count once for it.
                own = np.sort(positions(batch.column(0).to_pylist(), bits), axis=1)
                fresh = np.ones(own.shape, bool)
                fresh[:, 1:] = own[:, 1:] != own[:, :-1]
                held.append(own[fresh])
            if sum(map(len, held)) > HELD:
                yield chunks(held)
                held = []
        if held:
            yield chunks(held)

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """Positions of one chunk that were set more than once by all tasks together."""
    once = np.frombuffer(b"".join(table.column("once").to_pylist()), "<u2")
    often = np.frombuffer(b"".join(table.column("often").to_pylist()), "<u2")
    seen = np.bincount(once, minlength=1 << CHUNK)
    seen[often] = 2
    bits = np.packbits(seen > 1, bitorder="little").tobytes()
    return pa.table({"chunk": table.column("chunk").slice(0, 1), "bits": pa.array([bits])})


def repeat_filter(shas: DataFrame, rows: int, max_filter_bits: int = MAX_FILTER_BITS) -> np.ndarray:
    """Bytes of the filter of repeated bits for ``text_sha256`` rows; at most ``max_filter_bits`` bits."""
    bits = 1 << max(0, int(np.ceil(np.log2(max(1, BITS_PER_ROW * rows)))))
    bits = min(max(bits, MIN_FILTER_BITS), max_filter_bits)
    found = (
        map_arrow(shas.select("text_sha256"), _set_bits(bits), "chunk long, once binary, often binary")
        .groupBy("chunk")
        .applyInArrow(_repeated, "chunk long, bits binary")
    )
    out = np.zeros(bits // 8, np.uint8)
    for row in found.toLocalIterator():
        part = out[row.chunk << 13 : (row.chunk + 1) << 13]
        part[:] = np.frombuffer(row.bits, np.uint8)[: len(part)]
    return out


def _flag(filter_bytes, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = filter_bytes.value
        for batch in batches:
            shas = batch.column(batch.schema.get_field_index(column)).to_pylist()
            at = positions(shas, len(table) * 8)
            hit = ((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
            yield batch.append_column("__maybe", pa.array(hit, pa.bool_()))

    return run


def flag_repeats(rows: DataFrame, filter_bytes: np.ndarray) -> DataFrame:
    """``rows`` with ``__maybe``: false where the text certainly occurs once."""
    shared = rows.sparkSession.sparkContext.broadcast(filter_bytes)
    schema = with_columns_after(rows.schema, "__maybe boolean")
    return map_arrow(rows, _flag(shared, "text_sha256"), schema)


def _digested(docs: DataFrame, *columns: Column | str) -> DataFrame:
    n_chars = F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("__n_chars")
    rows = docs.select(*columns, n_chars)
    schema = with_columns_after(rows.drop("text").schema, "text_sha256 string")
    return map_arrow(rows, _digests, schema)


def exact_dedup(docs: DataFrame, max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, a row per row of ``docs``."""
    rows = checkpointed(_digested(docs, "doc_id", "text"))
    flagged = flag_repeats(rows, repeat_filter(rows, rows.count(), max_filter_bits))
    alone = flagged.where("not __maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    # Rows that cannot be told apart are counted, so a group of copies shuffles as few rows.
    kinds = checkpointed(
        flagged.where("__maybe")
        .groupBy("text_sha256", "__n_chars", "doc_id")
        .agg(F.count(F.lit(1)).alias("__copies"))
    )
    order = F.struct(-F.col("__n_chars"), F.isnull("doc_id"), F.col("doc_id"))
    # Written, so that both sides of the join are dealt for it alone: Spark then splits a hot text.
    groups = checkpointed(
        kinds.groupBy("text_sha256").agg(
            F.min(order).alias("__best"), F.sum("__copies").alias("group_size")
        )
    )
    repeated = (
        kinds.join(groups, "text_sha256")
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), "__copies")).alias("__nth"))
        .select(
            "doc_id", F.col("__best.doc_id").alias("keep_id"), "group_size",
            (order == F.col("__best")).__and__(F.col("__nth") == 1).alias("kept"),
            "text_sha256",
        )
    )
    return alone.unionByName(repeated)


def drop_exact_copies(docs: DataFrame, max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns.

    Rows with a text of its own never shuffle. Copies are reduced where they are read (a task sends
    on one row per text), so a group of any size stays small.
    """
    narrow = checkpointed(_digested(docs, "text").select("text_sha256"))
    rows = _digested(docs, whole_row(docs))
    flagged = flag_repeats(rows, repeat_filter(narrow, narrow.count(), max_filter_bits))
    alone = flagged.where("not __maybe").select("__row.*")
    identity = F.xxhash64(*[F.col("__row")[c] for c in docs.columns])
    order = F.struct(
        -F.col("__n_chars"), F.isnull("__row.doc_id"), F.col("__row.doc_id"), identity
    )
    kept = (
        flagged.where("__maybe")
        .groupBy("text_sha256")
        .agg(F.min_by("__row", order).alias("__row"))
        .select("__row.*")
    )
    return alone.unionByName(kept)

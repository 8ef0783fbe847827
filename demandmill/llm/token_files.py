"""Token ids in binary files: fixed-width bit packing with block offsets.

A file holds a shard, a range of documents in ascending ``doc_id`` order. Ids take as many bits as the
largest id of the vocabulary needs; eight ids fill as many whole bytes, so numpy packs and unpacks them
in eight column steps. Blocks of ``per_block`` ids begin at byte offsets that the footer lists, so any
run of ids is read from its blocks alone. Layout (numbers of eight bytes, most significant first):

    block, newline, block, newline, ...
    block offsets and the end of the last block   numbers
    documents                                     Arrow stream: doc_id, first id in this shard, ids
    place of the offsets, place of the documents, ids, documents, shard, bits, ids per block,
    ``MAGIC``, newline

Spark deals the texts out by range of (``doc_id``, hash of the text, row) and writes the files, so a
lost executor repeats its shard and half-written files are never seen. A ``doc_id`` that many rows share
is split over shards. A task streams blocks out; it holds one block and the shard's document table. An
index (Parquet) names each file's shard and the ids of all shards before it.

Ids are the library's. Texts of characters whose classes all Unicode versions agree on are cut into
the library's own words first and a worker remembers the ids of words up to a bound; other texts, and
other kinds of tokenizers, go to the library whole.

Null texts count as empty: such a document is its end id alone. Null ids come first. Rows that share a
``doc_id`` come by a hash of their text; equal rows are alike, each has its own place. Texts of any
length are encoded whole; one text is the least a task holds. Other columns do not matter. An empty
table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import Split

from demandmill.llm.common import map_arrow

MAGIC = b"bitids01"
TRAILER = struct.Struct(">7Q8s")
#: Ids of a block (a multiple of eight), bytes of text per shard.
PER_BLOCK, SHARD_BYTES = 1 << 15, 16 << 20
#: Rows of text encoded at once, words that a worker remembers, new words to a line.
TEXTS_AT_ONCE, REMEMBERED, LINES = 256, 600_000, 512
#: An index of up to so many files (some 40 MB) may be broadcast.
BROADCAST_FILES = 500_000

#: Characters whose classes have long been settled, so that every Unicode version cuts them alike.
SETTLED = (
    (0x0000, 0x04FF), (0x2010, 0x2027), (0x2030, 0x205E), (0x3041, 0x3096), (0x30A1, 0x30FA),
    (0x4E00, 0x9FA5), (0xAC00, 0xD7A3),
)


def _class(kind: str) -> str:
    """Settled characters of a Unicode category, for use between brackets."""
    out = []
    for first, last in SETTLED:
        points = (p for p in range(first, last + 1) if unicodedata.category(chr(p))[0] == kind)
        # Points in a row have one difference from their place.
        for _, run in groupby(enumerate(points), lambda x: x[1] - x[0]):
            run = [p for _, p in run]
            out.append(f"{re.escape(chr(run[0]))}-{re.escape(chr(run[-1]))}")
    return "".join(out)


def word_pattern() -> re.Pattern:
    """How byte-level tokenizers of this kind cut a text of settled characters into words."""
    letter, digit, space = _class("L"), _class("N"), "\t-\r \x85\xa0"
    return re.compile(
        f"'(?:[sdmt]|ll|ve|re)| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


# ---- packing ------------------------------------------------------------------------------------


def bits_for(vocabulary: int) -> int:
    """Least bits for ids below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids, each in ``bits`` bits (32 at most), lowest bit first; filled up to eight ids with zeros."""
    rows = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    rows.reshape(-1)[: len(ids)] = ids
    out = np.zeros((len(rows), bits), np.uint8)
    for nth in range(8):
        first, shift = divmod(nth * bits, 8)
        value = rows[:, nth] << np.uint64(shift)
        for k in range(first, (nth * bits + bits - 1) // 8 + 1):
            out[:, k] |= (value & np.uint64(255)).astype(np.uint8)
            value >>= np.uint64(8)
    return out.tobytes()


def unpack(packed: bytes | memoryview, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of ``pack``."""
    rows = np.frombuffer(packed, np.uint8).reshape(-1, bits)
    out = np.empty((len(rows), 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for nth in range(8):
        first, shift = divmod(nth * bits, 8)
        value = np.zeros(len(rows), np.uint64)
        for at, k in enumerate(range(first, (nth * bits + bits - 1) // 8 + 1)):
            value |= rows[:, k].astype(np.uint64) << np.uint64(8 * at)
        out[:, nth] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:count]


class Shard:
    """One file's ids and documents; only blocks that are asked for are unpacked."""

    def __init__(self, content: bytes) -> None:
        view = memoryview(content)
        end = len(view) - 1 - TRAILER.size
        offsets, documents, self.n_ids, self.n_docs, self.shard, self.bits, self.per_block, magic = (
            TRAILER.unpack(view[end:-1])
        )
        if magic != MAGIC:
            raise ValueError("not a file of packed token ids")
        self.view = view
        self.offsets = np.frombuffer(view[offsets:documents], ">u8").astype(np.int64)
        self._documents = view[documents:end]

    def documents(self) -> pa.Table:
        """``doc_id, first, n_tokens``; ``first`` counts from the beginning of the shard."""
        with pa.ipc.open_stream(self._documents) as stream:
            return stream.read_all()

    def block(self, nth: int) -> np.ndarray:
        count = min(self.per_block, self.n_ids - nth * self.per_block)
        # The last byte of a block's place is the newline behind it.
        return unpack(self.view[self.offsets[nth] : self.offsets[nth + 1] - 1], self.bits, count)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` (exclusive) of the shard."""
        if not 0 <= start <= end <= self.n_ids:
            raise IndexError(f"ids {start} to {end} of {self.n_ids}")
        if start == end:
            return np.empty(0, np.uint32)
        a, b = start // self.per_block, (end - 1) // self.per_block
        blocks = np.concatenate([self.block(n) for n in range(a, b + 1)])
        return blocks[start - a * self.per_block : end - a * self.per_block]


# ---- encoding -----------------------------------------------------------------------------------


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = sorted(set(range(256)) - set(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


class _Places(dict):
    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        return place


class Encoder:
    """The library's ids of texts; remembers words where they can be told apart safely."""

    def __init__(self, path: str) -> None:
        # Spark runs a worker per core; the library's own threads would only crowd them.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        kind = json.loads(self.tokenizer.to_str())
        pre, model = kind.get("pre_tokenizer") or {}, kind.get("model") or {}
        self.alphabet = byte_alphabet()
        # The same merges, over words that are cut already and end at line breaks.
        line_break = self.alphabet[10]
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = Split(line_break, "isolated")
        self.newline = self._library(["\n"])[0]
        self.by_words = (
            not kind.get("normalizer") and not kind.get("truncation") and not kind.get("padding")
            and pre.get("type") == "ByteLevel" and pre.get("use_regex") is True
            and not pre.get("add_prefix_space") and model.get("type") == "BPE"
            and not model.get("dropout") and len(self.newline) == 1
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.vocabulary = max(vocabulary.values(), default=0) + 1
        self.added = [t["content"] for t in kind.get("added_tokens") or []]
        settled = "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in SETTLED)
        self.unsettled, self.words = re.compile(f"[^{settled}]"), word_pattern()
        self.place = _Places()
        self.ids, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def forget(self) -> None:
        """Keep the words that came more than once, the most frequent half of the bound at most."""
        often = np.flatnonzero(self.uses > 1)
        most = max(1, REMEMBERED // 2)
        if len(often) > most:
            often = np.sort(often[np.argpartition(-self.uses[often], most)[:most]])
        words = list(self.place)
        self.place = _Places((words[i], n) for n, i in enumerate(often.tolist()))
        self.ids = self.ids[self._at(often)]
        self.sizes, self.uses = self.sizes[often], np.zeros(len(often), np.int64)

    def _at(self, words: np.ndarray) -> np.ndarray:
        """Where the ids of words stand in ``ids``."""
        sizes = self.sizes[words]
        ends = np.cumsum(sizes)
        starts = (np.cumsum(self.sizes) - self.sizes)[words]
        return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Ids of new words. Words that are not white space go through the merges in lines, a word each."""
        blank = [w.isspace() for w in words]
        spaces = iter(self._library([w for w, b in zip(words, blank) if b]))
        plain = [w for w, b in zip(words, blank) if not b]
        lines = [
            ("\n".join(plain[at : at + LINES]) + "\n").encode().decode("latin-1").translate(self.alphabet)
            for at in range(0, len(plain), LINES)
        ]
        found = self.merges.encode_batch_fast(lines, add_special_tokens=False)
        flat = np.concatenate([np.zeros(0, np.uint32), *(np.array(x.ids, np.uint32) for x in found)])
        ends = np.flatnonzero(flat == self.newline[0])
        if len(ends) != len(plain):
            raise ValueError("the tokenizer joins words over line breaks")
        starts = np.r_[0, ends[:-1] + 1]
        own = iter(zip(starts.tolist(), ends.tolist()))
        made = []
        for b in blank:
            if b:
                made.append(np.array(next(spaces), np.uint32))
            else:
                first, end = next(own)
                made.append(flat[first:end])
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        self.ids = np.concatenate([self.ids, *made])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.uses = np.concatenate([self.uses, np.zeros(len(made), np.int64)])

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        if len(self.place) > REMEMBERED:
            self.forget()
        place, known = self.place, len(self.place)
        at: list[int] = []
        cut: list[tuple[int, int] | None] = []
        for text in texts:
            if self.by_words and not self.unsettled.search(text) and not any(t in text for t in self.added):
                start = len(at)
                at.extend(map(place.__getitem__, self.words.findall(text)))
                cut.append((start, len(at)))
            else:
                cut.append(None)
        if len(place) > known:
            self._learn(list(islice(place, known, None)))
        words = np.array(at, np.int64)
        self.uses += np.bincount(words, minlength=len(self.uses))
        ids = self.ids[self._at(words)]
        upto = np.r_[0, np.cumsum(self.sizes[words])]
        for text, span in zip(texts, cut):
            if span is None:
                yield np.array(self._library([text])[0], np.uint32)
            else:
                yield ids[upto[span[0]] : upto[span[1]]]


@lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    return Encoder(path)


# ---- writing ------------------------------------------------------------------------------------


class _Writer:
    """Gathers ids into blocks and counts what the footer needs."""

    def __init__(self, bits: int, per_block: int) -> None:
        self.bits, self.per_block = bits, per_block
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.offsets = [0]

    def _block(self, ids: np.ndarray) -> bytes:
        packed = pack(ids, self.bits)
        self.offsets.append(self.offsets[-1] + len(packed) + 1)
        return packed

    def add(self, ids: np.ndarray) -> Iterator[bytes]:
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.per_block:
            flat = np.concatenate(self.held)
            full = len(flat) - len(flat) % self.per_block
            for at in range(0, full, self.per_block):
                yield self._block(flat[at : at + self.per_block])
            self.held, self.n_held = [flat[full:]], len(flat) - full

    def rest(self) -> Iterator[bytes]:
        if self.n_held:
            yield self._block(np.concatenate(self.held))

    def footer(self, documents: bytes, n_docs: int, shard: int) -> bytes:
        offsets = np.array(self.offsets, ">u8").tobytes()
        at = self.offsets[-1]
        return offsets + documents + TRAILER.pack(
            at, at + len(offsets), self.n_ids, n_docs, shard, self.bits, self.per_block, MAGIC
        )


def _written(tokenizer: str, end_id: int, per_block: int):
    """Blocks of one shard, then its footer, as rows of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(tokenizer)
        out = _Writer(bits_for(max(encoder.vocabulary, end_id + 1)), per_block)
        ids, sizes, kind = [], [], None
        end = np.array([end_id], np.uint32)
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                ids.append(part.column("doc_id"))
                texts = [t or "" for t in part.column("text").to_pylist()]
                for found in encoder(texts):
                    sizes.append(len(found) + 1)
                    for block in out.add(np.concatenate([found, end])):
                        yield _row(block)
        if kind is None:
            return
        for block in out.rest():
            yield _row(block)
        sizes = np.array(sizes, np.int64)
        table = pa.table(
            {
                "doc_id": pa.chunked_array(ids, kind),
                "first": pa.array(np.cumsum(sizes) - sizes, pa.int64()),
                "n_tokens": pa.array(sizes, pa.int64()),
            }
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table.combine_chunks())
        shard = TaskContext.get().partitionId()
        yield _row(out.footer(sink.getvalue().to_pybytes(), len(table), shard))

    return run


def _row(line: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([line], pa.binary())], ["line"])


def write_tokens(
    docs: DataFrame, tokenizer: str, path: str, end_id: int = 0,
    shard_bytes: int = SHARD_BYTES, per_block: int = PER_BLOCK,
) -> None:
    """Encode ``text`` of ``docs``, end each document with ``end_id`` and write ``path/ids``, ``path/index``.

    ``tokenizer`` is a file that every executor can open. ``shard_bytes`` of text go to a file.
    """
    if per_block % 8:
        raise ValueError("a block holds a multiple of eight ids")
    rows = docs.select("doc_id", "text")
    size = rows.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(64))).first()[0] or 0
    dealt = (
        rows.select("*", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("nth"))
        .repartitionByRange(max(1, -(-int(size) // shard_bytes)), F.asc_nulls_first("doc_id"), "h", "nth")
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "h", "nth")
        .select("doc_id", "text")
    )
    lines = map_arrow(dealt, _written(tokenizer, end_id, per_block), "line binary")
    # The bytes go to the file as they are, with a newline after each row.
    lines.select(F.col("line").cast("string")).write.text(f"{path}/ids", compression="none")
    _index(rows.sparkSession, path).write.parquet(f"{path}/index")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{path}/ids").select("path", "length", "content")


def _index(spark: SparkSession, path: str) -> DataFrame:
    """``file, shard, n_tokens, n_docs, start`` from the files' ends; a row per file."""

    def number(nth: int) -> Column:
        at = F.lit(-1 - TRAILER.size + 8 * nth)
        return F.conv(F.hex(F.substring("content", at, F.lit(8))), 16, 10).cast("long")

    # An empty table leaves an empty file.
    files = _files(spark, path).where("length > 0").select(
        F.substring_index("path", "/", -1).alias("file"), number(4).alias("shard"),
        number(2).alias("n_tokens"), number(3).alias("n_docs"),
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


# ---- reading ------------------------------------------------------------------------------------


def _read(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                shard = Shard(content.as_buffer())
                table = shard.documents()
                # Documents are taken in runs of about a block, so that a batch stays small.
                ends = np.cumsum(table.column("n_tokens").to_numpy())
                marks = np.arange(shard.per_block, ends[-1] + shard.per_block, shard.per_block)
                cuts = np.unique(np.r_[0, np.minimum(np.searchsorted(ends, marks) + 1, len(ends))])
                for a, b in zip(cuts, cuts[1:]):
                    yield _documents(shard, table.slice(a, b - a), with_ids)

    return run


def _documents(shard: Shard, table: pa.Table, with_ids: bool) -> pa.RecordBatch:
    first, sizes = (table.column(c).to_numpy() for c in ("first", "n_tokens"))
    ids = shard.ids(int(first[0]), int(first[-1] + sizes[-1]))
    offsets = np.r_[0, np.cumsum(sizes)]
    if with_ids:
        made = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(ids.astype(np.int64)))
    else:
        raw = memoryview(ids.astype("<u4").tobytes())
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])]
        made = pa.array(sums, pa.int64())
    plain = table.combine_chunks()
    columns = [plain.column(c).chunk(0) for c in ("doc_id", "first", "n_tokens")]
    shards = pa.array(np.full(len(sizes), shard.shard), pa.int64())
    name = "ids" if with_ids else "ids_crc32"
    return pa.RecordBatch.from_arrays(
        [shards, *columns, made], ["shard", "doc_id", "first", "n_tokens", name]
    )


def read_tokens(
    spark: SparkSession, path: str, with_ids: bool = True, doc_id: T.DataType | str = "long"
) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (end id included) of every document, from the files of ``path``.

    ``start`` is the number of ids of all documents before. Without ids their checksum is returned as
    ``ids_crc32``: crc32 over the ids as little-endian unsigned 32-bit integers.
    """
    kind = doc_id if isinstance(doc_id, str) else doc_id.simpleString()
    last = "ids array<long>" if with_ids else "ids_crc32 long"
    files = _files(spark, path).where("length > 0").select("content")
    found = map_arrow(files, _read(with_ids), f"shard long, doc_id {kind}, first long, n_tokens long, {last}")
    index = spark.read.parquet(f"{path}/index").select("shard", F.col("start").alias("before"))
    if index.count() <= BROADCAST_FILES:
        index = F.broadcast(index)
    return found.join(index, "shard").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", last.split()[0]
    )


def tokens_at(spark: SparkSession, path: str, start: int, count: int) -> np.ndarray:
    """``count`` ids from place ``start`` of all ids, from the files that hold them (fewer at the end)."""
    index = spark.read.parquet(f"{path}/index")
    hit = index.where((F.col("start") < start + count) & (F.col("start") + F.col("n_tokens") > start))
    parts = []
    for row in hit.orderBy("shard").collect():
        one = spark.read.format("binaryFile").load(f"{path}/ids/{row.file}").select("content").first()
        a, b = max(0, start - row.start), min(row.n_tokens, start + count - row.start)
        parts.append(Shard(bytes(one.content)).ids(a, b))
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def token_table(
    docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Write the files under ``path`` and read them back: ``doc_id, start, n_tokens, ids_crc32``."""
    write_tokens(docs, tokenizer, path, end_id, shard_bytes)
    return read_tokens(docs.sparkSession, path, False, docs.schema["doc_id"].dataType)

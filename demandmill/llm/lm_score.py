"""LM scoring: prediction by partial matching over a byte-context trie.

A text is its lower-cased (A-Z) words, one space between, and an end symbol. The trie holds every
context of up to ``order`` bytes seen in the texts learnt from, with the bytes that followed. A byte is
predicted from its longest known context; if it never followed there, an escape leads to the context
without its first byte, where the bytes of the longer one are excluded. Escapes are estimated from the
number of different bytes d among n occurrences: (2c - 1) / 2n for a byte seen c times, d / 2n for the
escape (method D). Full contexts count occurrences, shorter ones the different longer contexts. Below the
empty context the bytes never seen share what is left evenly, so every text has a probability.

The model is trained on all texts, then fixed, so the chance of a byte depends on its ``order + 1`` bytes
alone, its gram. That makes the work a few passes over distinct grams instead of positions:

1. Texts are packed into blocks of bounded size, written to the shared folder.
2. Each block sends its distinct grams and words with their training counts, cut by hash into at most
   ``FAN`` cells. Cells of as many blocks meet in a node, which adds them up and cuts them further, until
   a cell is a bucket of all blocks. A level has a bounded number of rows per block, so rows follow the
   input (blocks times buckets would follow its square); a key comes once per sender, so none is hot.
3. Buckets add up counts. Grams then go to the part of the trie that ends in their context's last two
   bytes (it holds their shorter contexts down to order two); the tables of orders one and zero have at
   most 256 x 256 numbers and go to every task. An ending of more than ``SPLIT`` grams is dealt by three
   bytes, each part with the ending's own table of order two (at most 256 numbers); at order five a part
   then holds 2^24 grams at most.
4. Answers go back the way the entries came: buckets and nodes answer each sender with the chances and
   counts of its entries, and blocks add up their texts.

Words are told apart by 63 bits of XXH64. Null text counts as empty and has the end symbol only. Rows that
share an id, and repeated rows, are scored one by one. An empty table gives no rows; with nothing learnt
from every byte has chance 1/256. Other columns do not matter.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandmill.llm.common import LOWER, map_arrow, texts_of
from demandmill.session import checkpointed, shared_dir
from demandmill.shipping import ship_package

ORDER = 5
#: The end symbol, also in front of every text; no word or space has this byte.
END = b"\n"
#: Bytes of text in a block, of text looked at together, and of text per bucket.
BLOCK, PART, PER_BUCKET = 32 << 20, 1 << 20, 32 << 20
#: Cells a block or node writes at most, and grams of a two-byte ending beyond which it is split.
FAN, SPLIT = 256, 1 << 17
#: Entries a block gathers before it adds up equal ones.
HELD = 1 << 20
ZSTD = pa.Codec("zstd", 3)


def normalised(text: bytes) -> bytes:
    return b" ".join(text.translate(LOWER).split())


def _pack(raw: bytes | np.ndarray) -> bytes:
    raw = raw if isinstance(raw, bytes) else raw.tobytes()
    return len(raw).to_bytes(8, "little") + ZSTD.compress(raw, asbytes=True)


def _unpacked(packed: bytes) -> bytes:
    size = int.from_bytes(packed[:8], "little")
    return ZSTD.decompress(memoryview(packed)[8:], size, asbytes=True) if size else b""


def _unpack(packed: bytes, kind) -> np.ndarray:
    return np.frombuffer(_unpacked(packed), kind)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences (which wrap round as the sums do)."""
    return _pack(np.diff(keys, prepend=np.int64(0)))


def _unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed, np.int64))


# ---- texts in blocks ----------------------------------------------------------------------------


def _tokens(text: bytes) -> int:
    """Words and one end."""
    return text.count(b" ") + 2 if text else 1


def _blocks(id_type: pa.DataType, limit: int):
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def packed() -> pa.RecordBatch:
            columns = [
                pa.array([(task << 32) + made], pa.int64()),
                pa.array([[i for i, _, _ in held]], pa.list_(id_type)),
                pa.array([[x for _, x, _ in held]], pa.list_(pa.bool_())),
                pa.array([[len(t) for _, _, t in held]], pa.list_(pa.int64())),
                pa.array([_pack(b"".join(t for _, _, t in held))], pa.binary()),
                pa.array([sum(_tokens(t) for _, taught, t in held if taught)], pa.int64()),
            ]
            names = ["block", "doc_ids", "learn", "sizes", "texts", "train_tokens"]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            ids, learn = batch.column("doc_id").to_pylist(), batch.column("learn").to_pylist()
            for doc_id, taught, text in zip(ids, learn, texts_of(batch)):
                held.append((doc_id, taught, normalised(text)))
                size += len(held[-1][2]) + 1
                if size >= limit:
                    yield packed()
                    made, held, size = made + 1, [], 0
        if held:
            yield packed()

    return run


def _texts(row: dict) -> Iterator[list[tuple[int, bytes, bool]]]:
    """Place, text and learn flag of a block's texts, in parts of bounded size."""
    raw, at, part, size = _unpacked(row["texts"]), 0, [], 0
    for n, (length, taught) in enumerate(zip(row["sizes"], row["learn"])):
        part.append((n, raw[at : at + length], taught))
        at, size = at + length, size + length + 1
        if size >= PART:
            yield part
            part, size = [], 0
    if part:
        yield part


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every byte and end symbol of all texts in a row, and their number per text."""
    flat = np.frombuffer(END * order + b"".join(t + END for t in texts), np.uint8).astype(np.int64)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    place = np.arange(len(flat) - order) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keys = flat[order:].copy()
    for back in range(1, order + 1):
        # Before a text lie end symbols, not the text before it.
        before = np.where(place >= back, flat[order - back : len(flat) - back], END[0])
        keys |= before << (8 * back)
    return keys, sizes


def word_keys(text: bytes) -> np.ndarray:
    """Negative keys, so that no word is a gram."""
    digest = xxhash.xxh64_intdigest
    found = np.array([digest(w) for w in text.split()], np.uint64)
    return (found | np.uint64(1 << 63)).view(np.int64)


#: The end symbol as a token.
END_WORD = -1


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[starts], np.add.reduceat(counts, starts) if len(keys) else counts


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    return (mixed % np.uint64(buckets)).astype(np.int64)


class Levels(NamedTuple):
    """How cells of blocks meet: digits of a bucket's number, their base, and sets of blocks by level.

    The node of a set and of the leading digits of a bucket is ``set * base^level + digits``; at the last
    level there is one set, and a node is a bucket.
    """

    base: int
    sets: tuple[int, ...]

    @property
    def buckets(self) -> int:
        return self.base ** len(self.sets)

    def node(self, level: int, senders: int, keys: np.ndarray) -> np.ndarray:
        """Node at a level (from 1) for keys of the set of senders with that number."""
        digits = _bucket(keys, self.buckets) // self.base ** (len(self.sets) - level)
        return senders % self.sets[level - 1] * self.base**level + digits


def levels_of(blocks: int, buckets: int, fan: int) -> Levels:
    depth = 1
    while fan**depth < buckets:
        depth += 1
    base = next(b for b in range(1, fan + 1) if b**depth >= buckets)
    sets = [blocks]
    for _ in range(depth - 1):
        sets.append(-(-sets[-1] // base))
    return Levels(base, (*sets[1:], 1))


def _cells(sender: int, nodes: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.Table:
    """A row per node: the sender's keys for it, in order, with their counts."""
    by_node = np.argsort(nodes, kind="stable")
    parts = np.split(by_node, np.flatnonzero(np.diff(nodes[by_node])) + 1)
    return pa.table(
        {
            "node": pa.array([int(nodes[p[0]]) for p in parts], pa.int64()),
            "sender": pa.array([sender] * len(parts), pa.int64()),
            "keys": pa.array([_pack_keys(keys[p]) for p in parts], pa.binary()),
            "counts": pa.array([_pack(counts[p]) for p in parts], pa.binary()),
        }
    )


ENTRIES = "node long, sender long, keys binary, counts binary"


def _entries(order: int, levels: Levels):
    """Rows of ``ENTRIES``: a block's distinct keys with their training counts."""

    def of_block(row: dict) -> list[pa.RecordBatch]:
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for part in _texts(row):
            if sum(map(len, keys[1:])) > HELD:
                merged = _counted(np.concatenate(keys), np.concatenate(counts))
                keys, counts = [merged[0]], [merged[1]]
            for flag in (True, False):
                texts = [t for _, t, taught in part if taught == flag]
                if not texts:
                    continue
                words = [word_keys(t) for t in texts]
                both = np.concatenate([grams(texts, order)[0], *words, np.full(len(texts), END_WORD)])
                distinct, n = np.unique(both, return_counts=True)
                keys.append(distinct)
                counts.append(n if flag else np.zeros_like(n))
        keys, counts = _counted(np.concatenate(keys), np.concatenate(counts))
        # Blocks have numbers by task; a digest deals them out evenly.
        group = xxhash.xxh64_intdigest(str(row["block"])) >> 1
        return _cells(row["block"], levels.node(1, group, keys), keys, counts).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                yield from of_block(batch.slice(n, 1).to_pylist()[0])

    return run


def _total(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [_unpack_keys(k) for k in table.column("keys").to_pylist()]
    counts = [_unpack(c, np.int64) for c in table.column("counts").to_pylist()]
    return _counted(np.concatenate(keys), np.concatenate(counts))


def _merged(level: int, levels: Levels):
    """Entries of the nodes of a level, added up and cut for the next one."""

    def run(table: pa.Table) -> pa.Table:
        keys, counts = _total(table)
        node = table.column("node")[0].as_py()
        return _cells(node, levels.node(level + 1, node // levels.base**level, keys), keys, counts)

    return run


def _totals(table: pa.Table) -> pa.Table:
    """Grams ``key, n`` of a bucket, and one row without a key: its different words learnt from."""
    keys, n = _total(table)
    gram = keys >= 0
    return pa.table(
        {
            "key": pa.array([None, *keys[gram].tolist()], pa.int64()),
            "n": pa.array([int((n[~gram] > 0).sum()), *n[gram].tolist()], pa.int64()),
        }
    )


# ---- the trie -----------------------------------------------------------------------------------


def _look(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key, and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


class Level:
    """All contexts of one order: their bytes' counts, sums, and what they exclude one order below."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.counts = keys, counts.astype(np.float64)
        self.contexts, at = np.unique(keys >> 8, return_inverse=True)
        self.at = at
        self.n = np.bincount(at, self.counts, len(self.contexts))
        self.d = np.bincount(at, minlength=len(self.contexts)).astype(np.float64)
        self.excluded = np.zeros(len(self.contexts))

    def exclude(self, below: Level, bits: int) -> None:
        """Count, in the shorter contexts, the bytes that these contexts know."""
        at, _ = _look(below.keys, self.keys & ((1 << bits) - 1))
        mass = below.counts[at] if len(below.keys) else np.zeros(len(self.keys))
        self.excluded = np.bincount(self.at, mass, len(self.contexts))


def low_levels(pairs: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Orders zero and one from the counts of (last byte, byte) pairs."""
    one = Level(pairs, counts)
    symbols, n = np.unique(pairs & 255, return_counts=True)
    zero = Level(symbols, n)
    one.exclude(zero, 8)
    return [zero, one]


def with_two(low: list[Level], grams: np.ndarray, counts: np.ndarray) -> list[Level]:
    """The low levels with order two of one ending: its bytes, each with its number of longer contexts."""
    order = np.argsort(grams)
    two = Level(grams[order], counts[order])
    two.exclude(low[1], 16)
    return [*low, two]


def chances(keys: np.ndarray, n: np.ndarray, low: list[Level], order: int) -> np.ndarray:
    """log10 chance of the last byte of each gram; grams with n > 0 were learnt.

    All grams that share a context's last bytes must be there: as many bytes as ``low`` has levels (all
    grams, for an order under two).
    """
    levels = dict(enumerate(low))
    known, counts = keys[n > 0], n[n > 0]
    for k in range(order, len(low) - 1, -1):
        levels[k] = Level(known, counts)
        known, counts = np.unique(known & ((1 << 8 * k) - 1), return_counts=True)
    for k in range(order, len(low) - 1, -1):
        levels[k].exclude(levels[k - 1], 8 * k)
    out, going = np.zeros(len(keys)), np.ones(len(keys), bool)
    less_n, less_d = np.zeros(len(keys)), np.zeros(len(keys))
    for k in range(order, -1, -1):
        level, short = levels[k], keys & ((1 << 8 * (k + 1)) - 1)
        context, seen = _look(level.contexts, short >> 8)
        symbol, hit = _look(level.keys, short)
        if not seen.any():
            continue
        total, kinds = level.n[context] - less_n, level.d[context] - less_d
        here = going & seen & (total > 0)
        hit &= here
        out[hit] += np.log10((2 * level.counts[symbol[hit]] - 1) / (2 * total[hit]))
        miss = here & ~hit
        out[miss] += np.log10(kinds[miss] / (2 * total[miss]))
        going &= ~hit
        less_n = np.where(seen, level.excluded[context], 0)
        less_d = np.where(seen, level.d[context], 0)
    symbols = len(levels[0].keys)
    out[going] += math.log10(1 / (256 - symbols)) if symbols < 256 else 0.0
    return out


# ---- answers to blocks --------------------------------------------------------------------------


def _handed(entries: pa.Table, keys: np.ndarray, values: np.ndarray) -> pa.Table:
    """Every sender's keys with their values, from all keys in order."""
    found = []
    for packed in entries.column("keys").to_pylist():
        found.append(_pack(values[np.searchsorted(keys, _unpack_keys(packed))]))
    return pa.table(
        {"sender": entries.column("sender"), "keys": entries.column("keys"), "found": pa.array(found, pa.binary())}
    )


def _joined(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the answers in order, and their values."""
    keys = np.concatenate([_unpack_keys(k) for k in answers.column("keys").to_pylist()])
    values = np.concatenate([_unpack(v, np.float64) for v in answers.column("found").to_pylist()])
    by_key = np.argsort(keys)
    return keys[by_key], values[by_key]


def _passed_on(entries: pa.Table, answers: pa.Table) -> pa.Table:
    """Answers to a node, handed to those that sent it their entries."""
    return _handed(entries, *_joined(answers))


def _answers(entries: pa.Table, scored: pa.Table) -> pa.Table:
    """A bucket's answers: log10 chance of grams, counts of words."""
    keys, values = _total(entries)
    values = values.astype(np.float64)
    order = np.argsort(scored.column("key").to_numpy())
    gram_keys = scored.column("key").to_numpy()[order]
    at, hit = _look(gram_keys, keys)
    values[hit] = scored.column("value").to_numpy()[order][at[hit]]
    return _handed(entries, keys, values)


def _scores(order: int, tokens: int, words: int, id_type: pa.DataType):
    floor = tokens + 0.1 * (words + 1)

    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        keys, values = _joined(answers)
        end = values[np.searchsorted(keys, END_WORD)]
        out: dict[str, list] = {n: [] for n in ("doc_id", "learn", "n_tokens", "n_known", "base_score", "score")}
        for row in blocks.to_pylist():
            out["doc_id"] += row["doc_ids"]
            out["learn"] += row["learn"]
            for part in _texts(row):
                gram, sizes = grams([t for _, t, _ in part], order)
                chance = values[np.searchsorted(keys, gram)]
                out["score"] += np.add.reduceat(chance, np.cumsum(sizes) - sizes).tolist()
                for _, text, _ in part:
                    own = word_keys(text)
                    count = np.append(values[np.searchsorted(keys, own)], end)
                    out["n_tokens"].append(len(count))
                    out["n_known"].append(int((count > 0).sum()))
                    out["base_score"].append(float(np.log10((count + 0.1) / floor).sum()))
        kinds = [id_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table({n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds)})

    return run


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _split(grams: DataFrame, split: int) -> tuple[DataFrame, DataFrame]:
    """Grams with the part of the trie they go to, and order two of endings that are split.

    There are at most 65,536 endings. A part of three bytes has its number from 2^16 on.
    """
    ending = lambda c, bits: F.shiftright(c, 8).bitwiseAND(F.lit((1 << bits) - 1))
    grams = grams.withColumn("ending", ending("key", 16))
    hot = grams.groupBy("ending").count().where(F.col("count") > split).select("ending")
    hot = F.broadcast(hot.withColumn("hot", F.lit(True)))
    three = ending("key", 24) + F.lit(1 << 16)
    parts = grams.join(hot, "ending", "left").select(
        "key", "n", "ending", F.when(F.col("hot"), three).otherwise(F.col("ending")).alias("part")
    )
    wide = parts.where(F.col("part") >= 1 << 16)
    longer = wide.where("n > 0").select(
        "ending", F.col("key").bitwiseAND(F.lit((1 << 32) - 1)).alias("k")
    ).distinct()
    two = longer.groupBy("ending", F.col("k").bitwiseAND(F.lit((1 << 24) - 1)).alias("gram")).count()
    return parts.drop("ending"), wide.select("ending", F.col("part").alias("home")).distinct().join(two, "ending").drop("ending")


def score(
    docs: DataFrame,
    learn: Column,
    order: int = ORDER,
    block: int = BLOCK,
    per_bucket: int = PER_BUCKET,
    fan: int = FAN,
    split: int = SPLIT,
) -> DataFrame:
    """``doc_id, learn, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    ``score`` is the model's log10 probability of a text, ``base_score`` that of single words with
    0.1 added to each count. ``order`` is between 1 and 6. Rows for which ``learn`` is true teach both.
    ``block`` and ``per_bucket`` are bytes of text, ``fan`` and ``split`` as in the module's text; none of
    them changes a result.
    """
    if not 1 <= order <= 6:
        raise ValueError("order must be between 1 and 6")
    spark = docs.sparkSession
    ship_package(spark)
    id_field = docs.schema["doc_id"]
    id_type = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string()}[id_field.dataType]
    rows = docs.select("doc_id", F.coalesce(learn, F.lit(False)).alias("learn"), "text")
    kind = id_field.dataType.simpleString()
    blocks = _written(
        map_arrow(
            rows, _blocks(id_type, block),
            f"block long, doc_ids array<{kind}>, learn array<boolean>, sizes array<long>, "
            "texts binary, train_tokens long",
        ),
        "lm-blocks",
    )
    sizes = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    found = blocks.agg(F.sum(sizes), F.sum("train_tokens"), F.count(F.lit(1))).first()
    volume, tokens, number = (x or 0 for x in found)
    levels = levels_of(number, max(1, math.ceil(volume / per_bucket)), fan)
    sent = [_written(map_arrow(blocks, _entries(order, levels), ENTRIES), "lm-entries")]
    for level in range(1, len(levels.sets)):
        sent.append(
            _written(sent[-1].groupBy("node").applyInArrow(_merged(level, levels), ENTRIES), "lm-entries")
        )
    totals = checkpointed(sent[-1].groupBy("node").applyInArrow(_totals, "key long, n long"))
    words = totals.where("key is null").agg(F.sum("n")).first()[0] or 0
    all_grams = totals.where("key is not null")
    known = all_grams.where("n > 0")
    kinds = known.select(F.col("key").bitwiseAND(F.lit((1 << 24) - 1)).alias("k")).distinct()
    if order >= 2:
        pairs = kinds.groupBy(F.col("k").bitwiseAND(F.lit((1 << 16) - 1)).alias("k")).count().collect()
    else:
        pairs = known.select(F.col("key").alias("k"), F.col("n").alias("count")).collect()
    pairs = sorted((r["k"], r["count"]) for r in pairs)
    table = np.array(pairs, np.int64).reshape(-1, 2)
    low = low_levels(table[:, 0], table[:, 1])

    def model(part: pa.Table, two: pa.Table) -> pa.Table:
        keys, n = part.column("key").to_numpy(), part.column("n").to_numpy()
        place = np.argsort(keys)
        known = low
        if two.num_rows:
            known = with_two(low, two.column("gram").to_numpy(), two.column("count").to_numpy())
        value = np.empty(len(keys))
        value[place] = chances(keys[place], n[place], known, order)
        home = pa.array(_bucket(keys, levels.buckets), pa.int64())
        return pa.table({"key": part.column("key"), "value": pa.array(value), "bucket": home})

    # Under order three an ending has at most 256 grams, or all of them count together.
    parts, two = _split(all_grams, split if order > 2 else 1 << 62)
    scored = (
        parts.groupBy("part")
        .cogroup(two.groupBy("home"))
        .applyInArrow(model, "key long, value double, bucket long")
    )
    answer = "sender long, keys binary, found binary"
    answers = sent[-1].groupBy("node").cogroup(scored.groupBy("bucket")).applyInArrow(_answers, answer)
    for entries in reversed(sent[:-1]):
        answers = entries.groupBy("node").cogroup(answers.groupBy("sender")).applyInArrow(_passed_on, answer)
    added = "learn boolean, n_tokens long, n_known long, base_score double, score double"
    out = (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("sender"))
        .applyInArrow(_scores(order, tokens, words, id_type), f"doc_id {kind}, {added}")
    )
    return out.select(
        "doc_id", "learn", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )

"""Prefix trie of conversations: what a training job saves where conversations begin alike.

Turns become ids of a dictionary, a conversation one array of ids. Conversations are dealt out by range
of (array, id) and sorted, so equal beginnings lie together; every ``SHARD_TURNS`` turns of a task are a
shard of their own. A shard builds a ternary search tree over the ids, inserting its different
sequences medians first, which keeps each node's children balanced. One traversal with a stack gives
the order in which members, leaves and savings are added up.

Only prefixes of a shard's first and last sequence can also occur in other shards. These boundary nodes
are merged: members and children are added up over the shards; a leaf or the saving of a boundary node
is then counted in one of its shards, added up along that shard's two boundary paths, and the sums are
added up over the shards. A shard has at most two paths of them, so nothing gathers in one task. Ids of
members that end at a boundary node are joined to text in each shard and hashed in a stream.

A conversation's turns are ordered by ``turn`` (null first), then role, then text; repeated rows are
turns of their own. Null roles and texts count as empty. Rows without ``conv_id`` (a whole number) belong
to no conversation and count nowhere. A text of any length counts whole; texts never meet in a task. A
conversation's ids, eight bytes a turn, are one row. Other columns do not matter. An empty table gives
no rows; conversations without turns are members of the root alone.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandmill.llm.common import map_arrow
from demandmill.session import checkpointed
from demandmill.shipping import ship_package

#: Turns (and conversations) of a shard.
SHARD_TURNS = 1 << 17
WORD = r"[^\x20\x09-\x0D]+"
#: Key of the root; another node's is the digest of its parent's key and its turn.
ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ---- sequences ----------------------------------------------------------------------------------


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, seq, words``: each conversation's turn ids in order, and the words of each turn's text.

    Equal turns (role and text) have equal ids.
    """
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    # The length of the role tells where the text begins.
    turn = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    turns = checkpointed(
        rows.select(
            "conv_id", F.row_number().over(order).alias("nth"),
            F.unhex(F.sha2(turn, 256)).alias("digest"),
            F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        )
    )
    # Written, so that ids stay and both sides of the join are dealt for it: Spark splits a hot turn.
    dictionary = checkpointed(
        turns.select("digest").distinct().withColumn("id", F.monotonically_increasing_id())
    )
    listed = F.sort_array(F.collect_list(F.struct("nth", "id", "words")))
    return (
        turns.join(dictionary, "digest")
        .groupBy("conv_id")
        .agg(listed.alias("turns"))
        .select("conv_id", F.col("turns.id").alias("seq"), F.col("turns.words").alias("words"))
    )


def rebuilt(sequences: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Every conversation c with its first h turns from conversation c - c % family instead.

    h is the unsigned crc32 of c's decimal text modulo ``most``. Fewer turns there give fewer.
    """
    first = sequences.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"),
        F.slice("seq", 1, most - 1).alias("base_seq"), F.slice("words", 1, most - 1).alias("base_words"),
    )
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    rows = sequences.withColumns({"h": head, "base": F.col("conv_id") - F.col("conv_id") % family})

    def joined(base: str, own: str):
        begin = F.coalesce(F.slice(base, F.lit(1), F.col("h")), F.array().cast("array<long>"))
        return F.concat(begin, F.slice(own, F.col("h") + 1, F.size(own))).alias(own)

    return rows.join(first, "base", "left").select(
        "conv_id", joined("base_seq", "seq"), joined("base_words", "words")
    )


# ---- one shard ----------------------------------------------------------------------------------


def medians_first(n: int) -> Iterator[int]:
    """0 .. n - 1, the middle first, then the middles of both halves, and so on."""
    ranges = [(0, n)]
    for a, b in ranges:
        if a < b:
            mid = (a + b) // 2
            yield mid
            ranges += [(a, mid), (mid + 1, b)]


class Tree:
    """Ternary search tree: a node has a smaller and a larger sibling, and the first of its children."""

    def __init__(self) -> None:
        self.turn, self.words, self.depth, self.up = [-1], [0], [0], [-1]
        self.low, self.high, self.down = [-1], [-1], [-1]

    def _new(self, turn: int, words: int, up: int) -> int:
        self.turn.append(turn)
        self.words.append(words)
        self.up.append(up)
        self.depth.append(self.depth[up] + 1)
        for links in (self.low, self.high, self.down):
            links.append(-1)
        return len(self.turn) - 1

    def insert(self, seq: list[int], words: list[int]) -> int:
        """The node of the sequence."""
        key, low, high, down = self.turn, self.low, self.high, self.down
        at = 0
        for turn, count in zip(seq, words):
            links, place = down, at
            node = links[place]
            while node >= 0 and key[node] != turn:
                links, place = (low if turn < key[node] else high), node
                node = links[place]
            if node < 0:
                node = links[place] = self._new(turn, count, at)
            at = node
        return at

    def order(self) -> list[int]:
        """All nodes, each after its parent."""
        out, stack = [], [0]
        while stack:
            node = stack.pop()
            out.append(node)
            stack += [n for n in (self.low[node], self.high[node], self.down[node]) if n >= 0]
        return out

    def path(self, node: int) -> list[int]:
        """From the root to the node."""
        out = []
        while node >= 0:
            out.append(node)
            node = self.up[node]
        return out[::-1]


def child_key(parent: bytes, turn: int) -> bytes:
    return hashlib.blake2b(parent + turn.to_bytes(8, "little", signed=True), digest_size=16).digest()


PART = (
    "key binary, parent_key binary, shard long, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, words long, "
    "ends_sha256 string, ends string"
)
_PART = pa.schema(
    [
        ("key", pa.binary()), ("parent_key", pa.binary()), ("shard", pa.int64()), ("conv_id", pa.int64()),
        ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
        ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
        ("words", pa.int64()), ("ends_sha256", pa.string()), ("ends", pa.string()),
    ]
)


def shard_parts(rows: list[tuple[int, list[int], list[int]]], shard: int) -> list[tuple]:
    """``PART`` rows of one shard from sorted ``conv_id, seq, words``.

    Nodes inside have no ``key``; their parent is named by id, or by key if it is a boundary node.
    Boundary nodes have what the shard alone adds to them, without other boundary nodes. Ends of boundary
    nodes are rows with ``ends``, from the member ``conv_id`` on.
    """
    starts = [i for i, r in enumerate(rows) if i == 0 or r[1] != rows[i - 1][1]]
    ranges = list(zip(starts, [*starts[1:], len(rows)]))
    tree, ends = Tree(), {}
    for nth in medians_first(len(ranges)):
        _, seq, words = rows[ranges[nth][0]]
        ends[tree.insert(seq, words)] = ranges[nth]
    size = len(tree.turn)
    keys = {0: ROOT}
    for row in (rows[0], rows[-1]):
        for node in tree.path(tree.insert(row[1], row[2]))[1:]:
            keys[node] = child_key(keys[tree.up[node]], tree.turn[node])

    members, least = [0] * size, [None] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    order = tree.order()
    for node in reversed(order):
        if node in ends:
            a, b = ends[node]
            members[node] += b - a
            first = rows[a][0]
            least[node] = first if least[node] is None else min(first, least[node])
        inside = node not in keys
        if inside:
            leaves[node] += not children[node]
            saved[node] += (members[node] - 1) * tree.words[node]
        up = tree.up[node]
        if up >= 0:
            members[up] += members[node]
            least[up] = least[node] if least[up] is None else min(least[node], least[up])
            if inside:
                children[up] += 1
                leaves[up] += leaves[node]
                saved[up] += saved[node]

    out = []
    for node in order:
        up, key = tree.up[node], keys.get(node)
        a, b = ends.get(node, (0, 0))
        joined = ",".join(str(rows[i][0]) for i in range(a, b))
        digest = hashlib.sha256(joined.encode()).hexdigest() if key is None else None
        out.append(
            (
                key, keys.get(up), shard, least[node], tree.depth[node],
                least[up] if up >= 0 and up not in keys else None,
                members[node], children[node], leaves[node], saved[node], tree.words[node], digest, None,
            )
        )
        if key is not None and b > a:
            out.append((key, None, shard, rows[a][0], *[None] * 8, joined))
    return out


def _parts(shard_turns: int):
    def batch(rows: list, shard: int) -> pa.RecordBatch:
        columns = zip(*shard_parts(rows, shard))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, _PART)], schema=_PART
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns, shard = [], 0, TaskContext.get().partitionId() << 32
        for found in batches:
            for row in zip(*(found.column(n).to_pylist() for n in ("conv_id", "seq", "words"))):
                held.append(row)
                turns += 1 + len(row[1])
                if turns >= shard_turns:
                    yield batch(held, shard)
                    held, turns, shard = [], 0, shard + 1
        if held:
            yield batch(held, shard)

    return run


# ---- merging ------------------------------------------------------------------------------------


def _rolled(table: pa.Table) -> pa.Table:
    """One shard's boundary nodes: what is in their subtrees there."""
    rows = sorted(table.to_pylist(), key=lambda r: -r["depth"])
    leaves, saved = defaultdict(int), defaultdict(int)
    for r in rows:
        leaves[r["key"]] += r["n_leaves"]
        saved[r["key"]] += r["saved_tokens"]
        if r["parent_key"] is not None:
            leaves[r["parent_key"]] += leaves[r["key"]]
            saved[r["parent_key"]] += saved[r["key"]]
    keys = [r["key"] for r in rows]
    return pa.table(
        {
            "key": pa.array(keys, pa.binary()),
            "n_leaves": pa.array([leaves[k] for k in keys], pa.int64()),
            "saved_tokens": pa.array([saved[k] for k in keys], pa.int64()),
        }
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, ends_sha256`` from pieces in order of key and first member."""
    last, digest = None, None
    for batch in batches:
        done = []
        for key, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if key != last:
                if last is not None:
                    done.append((last, digest.hexdigest()))
                last, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ends.encode())
        if done:
            yield _digests(done)
    if last is not None:
        yield _digests([(last, digest.hexdigest())])


def _digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    keys, digests = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"]
    )


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per node of the trie over ``conv_id, seq, words``.

    ``conv_id`` is the smallest member, ``parent_conv_id`` the parent's (null for the root), ``n_leaves``
    and ``saved_tokens`` sums over the subtree, ``ends_sha256`` the digest of the members that end there.
    """
    rows = checkpointed(sequences.select("conv_id", "seq", "words"))
    dealt = rows.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    parts = checkpointed(map_arrow(dealt, _parts(shard_turns), PART))
    shared = parts.where("key is not null and ends is null")
    merged = shared.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inside"), F.max("words").alias("words"), F.min("shard").alias("owner"),
    )
    merged = checkpointed(merged)
    below = merged.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(
        F.count(F.lit(1)).alias("below")
    )
    merged = checkpointed(
        merged.join(below, "key", "left").withColumn(
            "n_children", F.col("inside") + F.coalesce("below", F.lit(0))
        )
    )
    own = merged.select(
        "key", "owner", (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saving"),
    )
    mine = F.col("owner") == F.col("shard")
    ship_package(parts.sparkSession)
    sums = (
        shared.join(own, "key")
        .select(
            "shard", "key", "parent_key", "depth",
            (F.col("n_leaves") + F.when(mine, F.col("leaf")).otherwise(0)).alias("n_leaves"),
            (F.col("saved_tokens") + F.when(mine, F.col("saving")).otherwise(0)).alias("saved_tokens"),
        )
        .groupBy("shard")
        .applyInArrow(_rolled, "key binary, n_leaves long, saved_tokens long")
        .groupBy("key")
        .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    )
    pieces = parts.where("ends is not null").select("key", "conv_id", "ends")
    pieces = pieces.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends")
    ends = map_arrow(pieces, _hashed, "key binary, ends_sha256 string")
    names = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    boundary = (
        merged.join(sums, "key").join(ends, "key", "left").join(names, "parent_key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    )
    inside = parts.where("key is null")
    named = inside.where("parent_key is null")
    unnamed = inside.where("parent_key is not null").drop("parent_conv_id").join(names, "parent_key")
    return named.select(out).unionByName(unnamed.select(out)).unionByName(boundary.select(out))

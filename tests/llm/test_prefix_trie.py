"""Prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from demandmill.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\v\f\r"


def n_words(text):
    for c in SPACE[1:]:
        text = text.replace(c, " ")
    return len([w for w in text.split(" ") if w])


def plain(turns):
    """Nodes of {conv_id: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv in sorted(turns):
        seq = tuple(turns[conv])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(conv)
        ends[seq].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * n_words(node[-1][1]) if node else 0
        below = [sums[c] for c in children[node]]
        sums[node] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    return {
        (
            members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), len(children[n]),
            *sums[n], hashlib.sha256(",".join(map(str, ends.get(n, []))).encode()).hexdigest(),
        )
        for n in members
    }


def ordered(rows):
    """{conv_id: turns} of raw rows."""
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in turns.items()}


def rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    return out


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def some_rows(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        if conv % 20 == 7:
            continue
        for turn in range(rng.choice([1, 1, 2, 3, 5])):
            text = rng.choice(["a", "a b", "", None, "c\td  e", "über"])
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), text))
    return rows


@pytest.mark.parametrize("shard_turns", [1, 5, 40, pt.SHARD_TURNS])
def test_trie_equals_plain_nodes(spark, shard_turns):
    rows = some_rows(shard_turns)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = rows_of(pt.prefix_trie(pt.sequences(df), shard_turns))
    want = plain(ordered(rows))
    assert set(found) == want and len(found) == len(want)


@pytest.mark.parametrize("shard_turns", [3, pt.SHARD_TURNS])
def test_rebuilt_conversations(spark, shard_turns):
    rows = some_rows(77, 200)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = rows_of(pt.prefix_trie(pt.rebuilt(pt.sequences(df)), shard_turns))
    want = plain(rebuilt(ordered(rows)))
    assert set(found) == want and len(found) == len(want)


def test_hot_conversation_is_split_over_shards(spark):
    """A third of all conversations are alike, others share their first turn."""
    rows = [(c, t, "user", f"turn {t}") for c in range(400) for t in range(3)]
    rows += [(c, t, "user", "turn 0" if t == 0 else f"own {c} {t}") for c in range(400, 900) for t in range(2)]
    rows += [(c, 0, "user", "turn 0") for c in range(900, 1000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = rows_of(pt.prefix_trie(pt.sequences(df), 50))
    want = plain(ordered(rows))
    assert set(found) == want and len(found) == len(want)


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = [
        (1, None, "user", "first", 1, "x"), (1, 0, None, None, 2, None), (1, 0, "a", "b", 3, "y"),
        (1, 0, "a", "b", 3, "y"), (None, 0, "user", "nobody", 4, ""), (2, None, None, "", 5, ""),
        (-3, 5, "user", "first", 6, ""), (2, 1, "a" * 3, "long " * 200_000, 7, ""),
    ]
    df = spark.createDataFrame(rows, SCHEMA + ", seq long, key string")
    found = rows_of(pt.prefix_trie(pt.sequences(df), 2))
    want = plain(ordered(rows))
    assert set(found) == want and len(found) == len(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert pt.prefix_trie(pt.rebuilt(pt.sequences(df))).collect() == []


def test_turnless_conversations_are_members_of_the_root(spark):
    df = spark.createDataFrame([(5, [], []), (3, [], [])], "conv_id long, seq array<long>, words array<long>")
    assert rows_of(pt.prefix_trie(df)) == [
        (3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,5").hexdigest())
    ]


@given(st.lists(st.lists(st.integers(0, 3), max_size=5), min_size=1, max_size=30))
@settings(max_examples=200, deadline=None)
def test_one_shard_has_every_node_once(seqs):
    rows = sorted(((c, s, [1] * len(s)) for c, s in enumerate(seqs)), key=lambda r: (r[1], r[0]))
    parts = [p for p in pt.shard_parts(rows, 0) if p[-1] is None]
    prefixes = defaultdict(set)
    for c, s, _ in rows:
        for d in range(len(s) + 1):
            prefixes[tuple(s[:d])].add(c)
    want = sorted((len(p), min(m), len(m)) for p, m in prefixes.items())
    assert sorted((p[4], p[3], p[6]) for p in parts) == want


def test_medians_come_first_and_all_come():
    assert sorted(pt.medians_first(13)) == list(range(13))
    assert next(pt.medians_first(13)) == 6
    assert list(pt.medians_first(0)) == []


def test_tree_stays_balanced():
    tree = pt.Tree()
    for nth in pt.medians_first(1023):
        tree.insert([nth], [1])
    level, nodes = 0, [tree.down[0]]
    while nodes:
        nodes = [n for x in nodes for n in (tree.low[x], tree.high[x]) if n >= 0]
        level += 1
    assert level == 10

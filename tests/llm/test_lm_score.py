"""LM scoring against a plain trie walked byte by byte."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandmill.llm import lm_score, queries


def norm(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


class Trie:
    """Counts by context: occurrences in full contexts, different longer contexts in shorter ones."""

    def __init__(self, texts, order):
        self.order = order
        top = Counter()
        for words in texts:
            raw = b"\n" * order + " ".join(words).encode() + b"\n"
            for i in range(order, len(raw)):
                top[raw[i - order : i], raw[i]] += 1
        self.nodes = defaultdict(dict)
        for _ in range(order + 1):
            below = Counter()
            for (ctx, s), c in top.items():
                self.nodes[ctx][s] = c
                below[ctx[1:], s] += 1
            top = below

    def chance(self, ctx, s):
        excluded, out = set(), 0.0
        while True:
            here = {x: c for x, c in self.nodes.get(ctx, {}).items() if x not in excluded}
            n, d = sum(here.values()), len(here)
            if s in here:
                return out + math.log10((2 * here[s] - 1) / (2 * n))
            if n:
                out += math.log10(d / (2 * n))
            excluded |= set(self.nodes.get(ctx, {}))
            if not ctx:
                return out + math.log10(1 / (256 - len(excluded)))
            ctx = ctx[1:]

    def score(self, words):
        raw = b"\n" * self.order + " ".join(words).encode() + b"\n"
        return sum(self.chance(raw[i - self.order : i], raw[i]) for i in range(self.order, len(raw)))


def brute(rows, learn, order):
    words = [norm(t) for _, t, *_ in rows]
    taught = [w for w, x in zip(words, learn) if x]
    counts = Counter(x for w in taught for x in [*w, ("end",)])
    n, v = sum(counts.values()), len([c for c in counts if counts[c]])
    trie, out = Trie(taught, order), []
    for (doc_id, *_), w, x in zip(rows, words, learn):
        tokens = [*w, ("end",)]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        out.append((doc_id, x, len(tokens), sum(counts[t] > 0 for t in tokens), n, base, trie.score(w)))
    return sorted(out, key=repr)


def check(df, rows, learn_column, learn, order, **sizes):
    cols = ["doc_id", "learn", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = sorted((tuple(r) for r in lm_score.score(df, learn_column, order, **sizes).select(cols).collect()), key=repr)
    want = brute(rows, learn, order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


CASES = [
    (1, "the cat sat on the mat"), (2, None), (3, ""), (4, " \t\n"), (5, "The CAT\tsat"), (6, "é 😀 über"),
    (7, "a" * 3000), (8, "the the the"), (8, "the the the"), (9, "x\x0by\x1cz"), (None, "cat mat"), (10, "zz"),
]


@pytest.mark.parametrize("order", [1, 2, 3, 5, 6])
def test_cases(docs_of, order):
    taught = F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False))
    df = docs_of(CASES).withColumns({"block": F.lit("x"), "key": F.lit(1), "learn": F.lit("y")})
    check(df, CASES, taught, [r[0] is not None and r[0] % 2 == 1 for r in CASES], order)


@pytest.mark.parametrize("sizes", [
    {"per_bucket": 200},
    # Three levels of nodes; every ending of more than two grams is split.
    {"block": 60, "per_bucket": 200, "fan": 3, "split": 2},
    {"block": 1, "per_bucket": 100, "fan": 2, "split": 0},
])
@pytest.mark.parametrize("order", [2, 3, 4])
def test_small_blocks_buckets_and_parts_change_nothing(docs_of, sizes, order):
    rows = [(i, f"word{i % 7} and word{i % 11} or {i}") for i in range(60)]
    check(docs_of(rows), rows, F.col("doc_id") % 3 > 0, [i % 3 > 0 for i in range(60)], order, **sizes)


def test_split_parts_with_unknown_grams(docs_of):
    sizes = {"block": 40, "per_bucket": 50, "fan": 2, "split": 1}
    taught = F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False))
    check(docs_of(CASES), CASES, taught, [r[0] is not None and r[0] % 2 == 1 for r in CASES], 5, **sizes)


@pytest.mark.parametrize("blocks, buckets, fan", [(1, 1, 256), (38, 26, 256), (31000, 31000, 256), (70, 60, 3)])
def test_rows_between_levels_follow_the_blocks(blocks, buckets, fan):
    """A block or node writes at most ``fan`` cells, and no level has many more senders than blocks."""
    levels = lm_score.levels_of(blocks, buckets, fan)
    assert levels.base <= fan and levels.buckets >= buckets and levels.sets[-1] == 1
    for level, sets in enumerate(levels.sets, 1):
        nodes = sets * levels.base**level
        assert nodes <= 3 * max(blocks, buckets) + levels.buckets
    keys = np.arange(5000, dtype=np.int64) * 977
    for level in range(1, len(levels.sets) + 1):
        nodes = levels.node(level, 5, keys)
        assert len(np.unique(nodes)) <= levels.base**level
        # The next level cuts a node's keys into at most ``base`` cells.
        if level < len(levels.sets):
            one = keys[nodes == nodes[0]]
            assert len(np.unique(levels.node(level + 1, 5, one))) <= levels.base


def test_nothing_to_learn_from(docs_of):
    rows = [(1, "ab"), (2, None)]
    check(docs_of(rows), rows, F.lit(False), [False, False], 5)
    assert lm_score.score(docs_of([]), F.lit(True)).count() == 0


def test_chances_sum_to_one(docs_of):
    """Over all bytes after a known, a half known and an unknown context."""
    texts = ["banana bandana", "band", "an ant"]
    raw = [" ".join(norm(t)).encode() for t in texts]
    keys, _ = lm_score.grams(raw, 3)
    known, n = np.unique(keys, return_counts=True)
    for ctx in (b"ban", b"xan", b"xyz", b"\n\n\n"):
        every = (int.from_bytes(ctx, "big") << 8) + np.arange(256)
        both = np.union1d(known, every)
        counts = np.zeros(len(both), np.int64)
        counts[np.searchsorted(both, known)] = n
        pairs = np.unique(np.unique(known & 0xFFFFFF) & 0xFFFF, return_counts=True)
        chance = 10 ** lm_score.chances(both, counts, lm_score.low_levels(*pairs), 3)
        assert chance[np.searchsorted(both, every)].sum() == pytest.approx(1)


def test_documents(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op4_lm_score(spark, sf).collect()}
    learn = [zlib.crc32(str(r.doc_id).encode()) % 10 != 0 for r in rows]
    for doc_id, taught, n_tokens, n_known, n, base, score in brute(rows, learn, lm_score.ORDER):
        r = got[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not taught, n_tokens, n_known, n)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)

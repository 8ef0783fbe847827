"""SimHash against all pairs in plain Python."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from demandmill.llm import simhash


def plain_fingerprint(text, size=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    if words and not grams:
        grams = [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=2):
    """Component number of each fingerprint, by search over all pairs."""
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    label = np.full(len(fps), -1)
    for i in range(len(fps)):
        if label[i] < 0:
            todo = [i]
            label[i] = i
            while todo:
                for j in np.flatnonzero(near[todo.pop()] & (label < 0)):
                    label[j] = i
                    todo.append(j)
    return label


def brute(rows):
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    label = plain_components(fps)
    ids = {}
    for (doc_id, *_), c in zip(rows, label):
        if doc_id is not None:
            ids[c] = min(ids.get(c, doc_id), doc_id)
    return sorted(
        ((r[0], f"{fp:016x}", ids.get(c)) for r, fp, c in zip(rows, fps, label)), key=repr
    )


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(simhash.near_duplicates(documents)) == brute(rows)


CASES = [
    (1, None), (2, ""), (3, " \t"), (4, "One"), (5, "one"), (6, "a b"), (7, "a b c"), (8, "A  b\nc"),
    (9, "É b c"), (10, "é b c"), (None, "x y z w"), (None, "x y z w"), (11, "q " * 20_000),
    (12, "a b c"), (12, "a b c"), (13, "m n o"), (None, "m n o"),
]


def test_cases(docs_of):
    assert result(simhash.near_duplicates(docs_of(CASES))) == brute(CASES)
    assert result(simhash.near_duplicates(docs_of([]))) == []


def test_rows_that_stay(docs_of):
    df = docs_of(CASES).withColumns({"fp": F.lit(1), "first": F.lit("x")})
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    comps = {}
    for (doc_id, text), c in zip(CASES, plain_components([plain_fingerprint(t) for _, t in CASES])):
        comps.setdefault(c, []).append((doc_id is None, doc_id or 0))
    want = sorted(None if m[0] else m[1] for m in map(min, comps.values()) if True) if all(
        not min(v)[0] for v in comps.values()
    ) else None
    got = [r.doc_id for r in kept.collect()]
    if want is not None:
        assert sorted(got) == want
    assert len(got) == len(comps)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_lose_nothing(spark, radius):
    """Clusters and chains of fingerprints at known distances, over several partitions."""
    rng = random.Random(radius)
    fps = set()
    for _ in range(40):
        fp = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 30])):
            fps.add(fp)
            for _ in range(rng.randint(1, 3)):
                fp ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in fps]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r.u: r.root for r in simhash.components(simhash.links(nodes, radius)).collect()}
    got = [roots.get(x, x) for x in signed]
    want = plain_components(fps, radius)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_large_group_in_tiles():
    """One group over many tiles; rows in order of population count."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 1, dtype=np.uint64)[0]
    flips = rng.integers(0, 64, (3000, 4)).astype(np.uint64)
    fps = np.unique(base ^ np.bitwise_xor.reduce(np.uint64(1) << flips, axis=1))
    fps = fps[np.argsort(np.bitwise_count(fps), kind="stable")]
    pops = np.bitwise_count(fps).astype(np.int64)
    at, root = simhash.tile_links(np.zeros(len(fps), np.int64), pops, fps, 2)
    label = np.arange(len(fps))
    label[at] = root
    want = plain_components(fps.tolist())
    assert len(set(zip(label.tolist(), want.tolist()))) == len(set(label.tolist())) == len(set(want.tolist()))
    assert len(at) < len(fps)

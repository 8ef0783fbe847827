"""Native fingerprints against the same rule in plain Python, and against true similarity."""

import hashlib
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from demandmill.llm import fingerprints as fp


def spark_hash(seed, raw):
    return xxhash.xxh64_intdigest(raw, seed)


def plain_hashes(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "") or [""]
    coded = [spark_hash(42, w.encode()) for w in words]
    out = []
    for i in range(max(1, len(words) - 4)):
        h = 42
        for w in coded[i : i + 5]:
            h = spark_hash(h, struct.pack("<Q", w))
        out.append(h)
    return out


def plain_fingerprint(text):
    bins = {}
    for h in plain_hashes(text):
        at = (h >> 56) ^ 128  # signed order
        bins[at] = min(bins.get(at, 1 << 64), h)
    out = bytearray()
    for i in range(fp.BINS):
        places = [i, *((fp.FIRST[i] + t * fp.STEP[i]) % fp.BINS for t in range(fp.BINS))]
        out.append(bins[next(p for p in places if p in bins)] & 255)
    return "".join(f"{w:016x}" for w in struct.unpack("<32Q", bytes(out)))


def estimate(a, b):
    a, b = bytes.fromhex(a), bytes.fromhex(b)
    m = np.mean([x == y for x, y in zip(a, b)])
    return max(0.0, (m - 1 / 256) / (1 - 1 / 256))


def edited(rows):
    """Texts and next texts, descending id, ties by text."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc_id, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        out.append((doc_id, text, text[: len(text) - half] + after[:half], after))
    return out


def check(df, rows):
    got = sorted((tuple(r) for r in fp.edited_fingerprints(df).collect()), key=repr)
    want = []
    for doc_id, text, new, after in edited(rows):
        a, b, c = map(plain_fingerprint, (text, new, after))
        want.append(
            (doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), a, b, estimate(a, b), estimate(a, c))
        )
    want.sort(key=repr)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want])


CASES = [
    (1, None), (2, ""), (3, " \t "), (4, "one"), (5, "a b c d e"), (6, "a b c d e f"), (7, "é ü 😀 x y z"),
    (8, " lead and trail \n"), (9, "w" * 30_000), (10, "v w x y z " * 4000), (40, "a b c d e"),
    (2**62, "far away"), (-5, "below zero"),
]


def test_cases(docs_of):
    check(docs_of(CASES).withColumns({"fp": F.lit(1), "n_chars": F.lit("x")}), CASES)


def test_ties_and_null_ids(docs_of):
    rows = [(None, "q r s t u"), (None, "b"), (1, "z z"), (1, "a a"), (1, "z z"), (3, "c d e f g")]
    check(docs_of(rows), rows)
    assert fp.edited_fingerprints(docs_of([])).count() == 0
    check(docs_of([(7, "only one row here is its own next")]), [(7, "only one row here is its own next")])
    check(docs_of([(None, "x y"), (None, "a b")]), [(None, "x y"), (None, "a b")])


@pytest.mark.parametrize("bucket_rows", [1, 3, 50])
def test_buckets_change_nothing(docs_of, monkeypatch, bucket_rows):
    """Also with ids in clusters and gaps."""
    monkeypatch.setattr(fp, "BUCKET_ROWS", bucket_rows)
    ids = [*range(40), *range(10_000, 10_020), 10**9, 10**12, *range(-3, 0)]
    rows = [(i, " ".join(f"w{(i * k) % 97}" for k in range(1, 12))) for i in ids]
    check(docs_of(rows), rows)


def test_estimates_are_near_true_similarity(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: r for r in fp.edited_fingerprints(documents).collect()}
    errors = []
    for doc_id, text, new, after in edited(rows):
        a, b, c = (set(plain_hashes(t)) for t in (text, new, after))
        errors.append(got[doc_id].near_edited - len(a & b) / len(a | b))
        errors.append(got[doc_id].near_next - len(a & c) / len(a | c))
    assert abs(np.mean(errors)) < 0.01 and np.mean(np.abs(errors)) < 0.03


def test_no_python_in_the_plan(documents):
    plan = fp.edited_fingerprints(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_ids_at_the_ends_of_the_range(docs_of):
    rows = [((1 << 63) - 1, "a b c"), (-(1 << 63), "d e f"), (0, "g"), (5, "h i")]
    out = {r.doc_id: r for r in fp.edited_fingerprints(docs_of(rows)).collect()}
    assert set(out) == {r[0] for r in rows}
    assert out[(1 << 63) - 1].edited_sha256 == hashlib.sha256(b"a bh i"[:5]).hexdigest()

"""Mixing: targets against repeated sharing, samples against their budgets."""

import re

import pytest
from pyspark.sql import functions as F

from demandmill.llm import mixing


def brute_targets(sizes, weights=(3, 1, 2), budget=1.5, limit=2):
    """Share by weight, stop at the limit, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = budget * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= limit * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = float(limit * sizes[s])
        left -= sum(limit * sizes[s] for s in over)
        open_ -= over
    return out


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(df, rows, near=None):
    got = [(r["__row"].doc_id, r["__row"].source, r["__row"].text, r) for r in df.collect()]
    assert len(got) == len(rows)
    sizes, taken, largest = {}, {}, {}
    for doc_id, source, text, r in got:
        assert r["size"] == words(text) and 0 <= r.copies <= 2
        sizes[source] = sizes.get(source, 0) + r["size"]
        taken[source] = taken.get(source, 0) + r["size"] * r.copies
        largest[source] = max(largest.get(source, 0), r["size"])
    want = brute_targets(sizes) if sizes else {}
    for _, source, _, r in got:
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source], abs=1e-6)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= (near or largest[s] / 2) + 1e-6, s


def test_documents(documents):
    rows = documents.collect()
    check(mixing.mix(documents), rows)
    again = mixing.mix(documents.repartition(7))
    key = lambda d: sorted((r["__row"].doc_id, r.copies) for r in d.collect())
    assert key(mixing.mix(documents)) == key(again)


def test_cases(docs_of):
    rows = [
        (1, "a b c", None, "s1"), (2, "", None, "s1"), (3, None, None, "s1"), (4, " lead", None, "s2"),
        (5, "trail ", None, "s2"), (6, "x\x0by\x1cz", None, None), (7, " \t\n", None, "empty"),
        (8, "long " * 30_000, None, "s3"), (None, "no id", None, "s3"), (9, "w " * 7, None, "S"),
        (10, "one", None, "\U0001f600"),
    ]
    check(mixing.mix(docs_of(rows)), rows)
    assert mixing.mix(docs_of([])).count() == 0
    assert mixing.mix(docs_of([(1, None), (2, "")])).where("copies > 0").count() == 0


def test_repeated_rows_are_drawn_one_by_one(docs_of):
    """Equal rows, shared ids and null ids: the words taken stay near the target."""
    cases = [
        [(7, "a b c d e", None, "s")] * 100,
        [(7, f"a b c d {i}", None, "s") for i in range(100)],
        [(None, f"a b c d {i}", None, "s") for i in range(100)],
        [(None, "a b c d e", None, "s")] * 40 + [(i, "a b c d e", None, "s") for i in range(60)],
    ]
    for rows in cases:
        df = mixing.mix(docs_of(rows))
        got = df.collect()
        assert len(got) == 100
        assert abs(sum(r["size"] * r.copies for r in got) - 750) <= 5
        assert {r.copies for r in got} == {1, 2}
        again = mixing.mix(docs_of(rows, 7)).collect()
        assert sorted((str(r["__row"]), r.copies) for r in got) == sorted((str(r["__row"]), r.copies) for r in again)


def test_the_sample_equals_a_plain_sort(docs_of):
    """Ranks sorted row by row, the words of a source added up in that order."""
    rows = [(i, "w " * (1 + i % 7), None, f"s{i % 2}") for i in range(400)] + [(3, "w w w", None, "s1")] * 50
    df = docs_of(rows)
    got = mixing.mix(df).collect()
    check(mixing.mix(df), rows)
    own = df.select("*", *mixing._identity(df)).collect()
    numbers, want = {}, {}
    ids = {}
    for r in own:
        nth = numbers.setdefault((r["__g"], r["__h"]), [])
        nth.append(len(nth))
        ids.setdefault(r.source, []).append((r["__g"], r["__h"], nth[-1], r.doc_id, len((r.text or "").split())))
    plan = {r["__row"].source: (r.source_size, r.target) for r in got}
    spark = df.sparkSession
    for source, members in ids.items():
        keys = spark.createDataFrame([m[:3] for m in members], "__g long, __h long, nth long")
        units = [r["__u"] for r in keys.select(mixing._unit(F.col("nth"), mixing.SEED)).collect()]
        size, target = plan[source]
        chance = target / size
        whole, p = int(chance), chance - int(chance)
        wanted, upto = target - whole * size, 0
        rank = lambda u: u * (1 - p) / (u * (1 - p) + (1 - u) * p)
        for u, m in sorted((rank(u), m) for u, m in zip(units, members)):
            upto += m[4]
            key = (source, m[3], m[4])
            want[key] = want.get(key, 0) + whole + (upto - m[4] / 2 <= wanted and p > 0)
    found = {}
    for r in got:
        key = (r["__row"].source, r["__row"].doc_id, r["size"])
        found[key] = found.get(key, 0) + r.copies
    assert found == want


def test_rows_of_the_mix(docs_of):
    rows = [(i, "a b c d", None, f"s{i % 3}") for i in range(300)]
    df = docs_of(rows).withColumns({"copies": F.lit("x"), "size": F.lit(1), "target": F.lit(2)})
    out = mixing.mixed_rows(df)
    assert out.columns == df.columns
    plan = {r["__row"].doc_id: r.copies for r in mixing.mix(df).collect()}
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {i: c for i, c in plan.items() if c}


def test_chances_follow_weights(docs_of):
    """Over many seeds a document of double weight is taken twice as often."""
    rows = [(i, "w " * 10, None, "s") for i in range(40)]
    df = docs_of(rows, 1)
    heavy = F.when(F.col("doc_id") < 10, 2.0).otherwise(1.0)
    light = dark = 0
    for seed in range(8):
        got = mixing.mix(df, budget=0.3, seed=seed, weight=heavy).collect()
        light += sum(r.copies for r in got if r["__row"].doc_id >= 10) / 30
        dark += sum(r.copies for r in got if r["__row"].doc_id < 10) / 10
        assert sum(r.copies for r in got) == 12
    assert 1.3 < dark / light < 3

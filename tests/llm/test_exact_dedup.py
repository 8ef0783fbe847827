"""Exact dedup against grouping in plain Python."""

import hashlib
import re
from collections import defaultdict

from demandmill.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, (doc_id, text, *_) in enumerate(rows):
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[norm].append((-len(text or ""), doc_id is None, doc_id, i))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: (m[:2], m[2] or 0))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        for m in members:
            out.append((m[2], best[2], len(members), m is best, sha))
    return sorted(out, key=repr)


def result(df):
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r) for r in df.select(cols).collect()), key=repr)


CASES = [
    (1, "a b"), (2, "ab"), (3, "a  b"), (4, "a\tb "), (5, None), (6, ""), (7, " \n"),
    (8, "ä b"), (9, "äb"), (10, "x" * 50_000), (11, "x" * 50_000), (12, "a b"),
    (None, "q"), (13, "q"), (None, "r"), (None, "r"), (14, "z"), (14, "z"), (14, "z "),
    (15, "alone"),
]


def test_cases(docs_of):
    assert result(exact_dedup.exact_dedup(docs_of(CASES))) == brute(CASES)


def test_small_filter_changes_no_result(docs_of):
    """Every row is a false positive then."""
    rows = [(i, f"t{i % 700}") for i in range(2000)]
    df = docs_of(rows)
    assert result(exact_dedup.exact_dedup(df, max_filter_bits=1 << 10)) == brute(rows)


def test_empty_table(docs_of):
    assert result(exact_dedup.exact_dedup(docs_of([]))) == []
    assert exact_dedup.drop_exact_copies(docs_of([])).count() == 0


def test_rows_that_stay(docs_of):
    kept = exact_dedup.drop_exact_copies(docs_of(CASES))
    want = [(r[0], r[4]) for r in brute(CASES) if r[3]]
    got = [(r.doc_id, exact_dedup.digest((r.text or "").encode()).hex()) for r in kept.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_clashing_columns(docs_of):
    from pyspark.sql import functions as F

    df = docs_of(CASES).withColumns(
        {"kept": F.lit(1), "text_sha256": F.lit("x"), "keep_id": F.lit(0), "once": F.lit(2)}
    )
    assert result(exact_dedup.exact_dedup(df)) == brute(CASES)
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns and {r.kept for r in kept.collect()} == {1}


def test_only_possible_repeats_shuffle(docs_of, spark):
    rows = [(i, f"text {i}") for i in range(3000)] + [(9000 + i, "same") for i in range(50)]
    df = exact_dedup._digested(docs_of(rows), "doc_id", "text")
    flagged = exact_dedup.flag_repeats(df, exact_dedup.repeat_filter(df, 3050))
    assert 50 <= flagged.where("__maybe").count() < 150
    assert flagged.where("__maybe and doc_id >= 9000").count() == 50

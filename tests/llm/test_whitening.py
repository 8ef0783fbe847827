"""Whitening against numpy's eigenvectors and exact whole numbers."""

import math

import numpy as np
import pytest

from demandmill.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(vectors, wanted):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors], object)
    n, total = len(x), x.sum(axis=0)
    y = ((n * x - total) / n).astype(float)
    cov = y.T @ y / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:wanted], vecs[:, ::-1][:, :wanted]
    deviation = ((n * x - total) ** 2).sum(axis=1)
    return y @ vecs / np.sqrt(values), values / np.trace(cov), deviation


def checked(rows, ids, vectors, wanted=8):
    k = min(wanted, len(vectors[0]))
    white, explained, deviation = plain(vectors, k)
    found = sorted((tuple(r) for r in rows), key=lambda r: (r[0], r[1]))
    assert [r[:2] for r in found] == [(i, c + 1) for i in sorted(ids) for c in range(k)]
    order = np.argsort(ids, kind="stable")
    got = np.array([r[4] for r in found]).reshape(-1, k)
    sign = np.sign((got * white[order]).sum(axis=0))
    assert np.abs(got * sign - white[order]).max() < 1e-7
    assert [int(r[3]) for r in found[::k]] == [int(d) for d in deviation[order]]
    assert {r[2] for r in found} == {len(vectors)}
    assert np.allclose([r[5] for r in found[:k]], explained, rtol=1e-9)
    assert len({r[6] for r in found}) == 1 and found[0][6] < 1e-9


@pytest.mark.parametrize("n, dimension", [(300, 64), (40, 5), (2000, 100)])
def test_equals_eigenvectors(spark, n, dimension):
    rng = np.random.default_rng(n)
    scale = np.linspace(1, 3, dimension)
    vectors = (rng.standard_normal((n, dimension)) * scale).astype(np.float32).tolist()
    df = spark.createDataFrame([(i, v, None) for i, v in enumerate(vectors)], SCHEMA).repartition(4)
    checked(wh.whiten(df).collect(), list(range(n)), vectors)


def test_whole_table(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [r for r in table.collect() if r.embedding and all(c is not None and math.isfinite(c) for c in r.embedding)]
    checked(wh.whiten(table).collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_rows_left_out_and_repeats(spark):
    rng = np.random.default_rng(1)
    good = rng.standard_normal((60, 3)).astype(np.float32).tolist()
    good += [good[0]] * 30
    odd = [None, [], [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [1.0] * 4]
    rows = [(i, v, 0) for i, v in enumerate(good)] + [(1000 + i, v, 0) for i, v in enumerate(odd)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    checked(wh.whiten(df).collect(), list(range(len(good))), good)


def test_null_and_shared_ids_keep_their_rows(spark):
    rows = [(None, [0.0, 1.0], 0), (7, [1.0, 0.0], 0), (7, [3.0, 5.0], 1), (None, [2.0, 2.0], 0)]
    found = wh.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str(r.vec_id) for r in found) == ["7"] * 4 + ["None"] * 4


def test_no_variance(spark):
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(5)]
    found = wh.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 15 and {(r.whitened, r.explained, r.identity_error) for r in found} == {(0, 0, 0)}
    assert {int(r.deviation) for r in found} == {0}


def test_rank_below_the_components(spark):
    rng = np.random.default_rng(3)
    flat = rng.standard_normal((200, 2)) @ rng.standard_normal((2, 60)) * 8
    x = wh.whole(flat)
    exact = np.round(flat * 0) + x[:1]  # one vector repeated, then moved along one direction
    rows = [(i, (exact[0] / 1024 + (i % 2) * np.arange(60)).tolist(), 0) for i in range(50)]
    found = wh.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    first = [r for r in found if r.component == 1]
    assert first[0].explained == pytest.approx(1) and first[0].identity_error < 1e-9
    assert {abs(round(r.whitened, 6)) for r in first} == {1.0}
    assert {r.whitened for r in found if r.component > 1} == {0.0}


def test_no_vectors(spark):
    assert wh.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert wh.whiten(spark.createDataFrame([(1, None, 0), (2, [], 0)], SCHEMA)).collect() == []


def test_large_entries_stay_exact(spark):
    rows = [(0, [3e38, 0.0], 0), (1, [-3e38, 1.0], 0), (2, [0.0, 2.0], 0)]
    found = wh.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    big = wh.LARGEST
    x = [(big + 100000, 100000), (-big + 100000, 101024), (100000, 102048)]
    total = [sum(c) for c in zip(*x)]
    want = [sum((3 * a - t) ** 2 for a, t in zip(v, total)) for v in x]
    assert [int(r.deviation) for r in sorted(found, key=lambda r: r.vec_id) if r.component == 1] == want


def test_close_eigenvalues_are_certified():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    values = np.r_[10.0, 5 + 1e-6 * np.arange(9)[::-1], np.linspace(4.99, 0, 290)]
    cov = (q * values) @ q.T
    found, vectors, residual = wh.leading_pairs(lambda b: cov @ b, 300, 8)
    assert residual < 1e-13 and np.allclose(found, values[:8], rtol=1e-12)
    assert np.abs(cov @ vectors.T - vectors.T * found).max() < 1e-11


def test_missed_direction_is_found():
    """A start without any part of the second direction finds it by the fresh random block."""
    values = np.r_[9.0, 8.0, np.linspace(3, 1, 98)]
    cov = np.diag(values)
    block = np.eye(100)[:, [0, *range(2, 33)]]
    missed = wh._missed(lambda b: cov @ b, block, values[[0, *range(2, 33)]], 8, 8, np.random.default_rng(0))
    assert missed is not None and abs(missed[1]).max() > 0.9

"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

An entry c counts as the whole number x = floor(1024 c) + 100000, clipped to 2^40 on both sides.
Sums are exact; every later pass subtracts the mean first, then multiplies, so the covariance V is
never formed: a pass returns V Q for a block Q of columns. A round applies a Chebyshev polynomial of V
to the block (a pass per degree) that damps all eigenvalues below the block's smallest Ritz value,
makes the block orthonormal (QR) and solves the small projected problem (Rayleigh-Ritz). Rounds go on
until the wanted pairs' residuals are as small as rounding lets them be. A fresh random block,
orthogonal to the result and filtered alike, must then find no larger eigenvalue; else its columns
join in and the rounds go on.

Tasks add up a dimension x columns table each, and Spark adds these by dimension; only the sums reach
the driver (``(wanted + GUARD) x dimension`` numbers whatever the number of vectors). The block goes to
the tasks with each pass.

Vectors that are null or hold null or non-finite entries are left out, as are those of another length
than most have (of equally frequent lengths the longer counts), and empty ones. Null or repeated ids
are kept, repeated vectors count as often as they occur. Equal eigenvalues have no order of their own.
A component without variance is whitened to 0 and explains 0. A vector is one row of a task, whatever
its length. Other columns do not matter. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandmill.llm.common import map_arrow
from demandmill.session import checkpointed

SCALE, SHIFT, LARGEST = 1024.0, 100_000, 1 << 40
#: Columns of a block beside the wanted ones, degree of the filter.
GUARD, DEGREE = 32, 8
#: Residuals against the largest eigenvalue: small enough at once; acceptable when they stop falling.
CERTAIN, ACCEPTED, ROUNDS = 2e-14, 1e-9, 300
#: Bytes of a stored block of vectors.
BLOCK_BYTES = 4 << 20
#: A component whose eigenvalue is below this part of the largest has no variance.
NOTHING = 1e-13


@dataclass(frozen=True)
class Whitening:
    """Fitted components, one per row of ``vectors``, by falling eigenvalue."""

    n: int
    total: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    passes: int

    @property
    def dimension(self) -> int:
        return len(self.total)

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace > 0 else np.zeros(len(self.values))

    @property
    def projection(self) -> np.ndarray:
        """Dimension x components: centred vectors times this are whitened."""
        useful = self.values > NOTHING * max(self.values.max(initial=0), 0)
        scale = np.where(useful, 1 / np.sqrt(np.where(useful, self.values, 1)), 0)
        return self.vectors.T * scale


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows with a vector of finite entries."""
    finite = F.forall(
        column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    )
    return vectors.where(F.col(column).isNotNull() & F.coalesce(finite, F.lit(False)))


def usual_length(vectors: DataFrame, column: str = "embedding") -> int:
    """The length that most vectors have; 0 without vectors."""
    lengths = vectors.groupBy(F.size(column).alias("d")).count().where("d > 0")
    first = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    return first.d if first else 0


def whole(entries: np.ndarray) -> np.ndarray:
    """The whole number of each entry."""
    scaled = np.clip(np.floor(entries.astype(np.float64) * SCALE), -LARGEST, LARGEST)
    return scaled.astype(np.int64) + SHIFT


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return whole(column.flatten().to_numpy(zero_copy_only=False)).reshape(-1, dimension)


def _blocks(dimension: int):
    """Vectors as rows of bytes, a few thousand vectors each."""
    size = max(1, BLOCK_BYTES // (8 * dimension))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), dimension)
            for at in range(0, len(x), size):
                raw = pa.array([x[at : at + size].tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([raw], ["x"])

    return run


def _arrays(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for raw in batch.column("x"):
            yield np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, dimension)


def _totals(blocks: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dimension, object)
        for x in _arrays(batches, dimension):
            n += len(x)
            total += x.sum(axis=0).astype(object)
        if n:
            sums = pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))
            at, ns = pa.array(range(dimension), pa.int32()), pa.array([n] * dimension, pa.int64())
            yield pa.RecordBatch.from_arrays([at, ns, sums], ["i", "n", "s"])

    parts = map_arrow(blocks, run, "i int, n long, s decimal(38,0)")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()
    return (rows[0].n, [int(r.s) for r in rows]) if rows else (0, [])


class Centre:
    """The mean as whole numbers and the rest of it, so that differences are exact before they round."""

    def __init__(self, n: int, total: list[int] | tuple[int, ...]) -> None:
        self.n = n
        self.near = [(2 * s + n) // (2 * n) for s in total]
        self.over = [s - n * m for s, m in zip(total, self.near)]
        self._near = np.array(self.near, np.int64)
        self._rest = np.array([o / n for o in self.over])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self._near) - self._rest

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)^2, exact."""
        near = x - self._near
        bound = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if x.shape[1] * bound * bound < 1 << 62:
            z = self.n * near - np.array(self.over, np.int64)
            return (z * z).sum(axis=1).tolist()
        z = self.n * near.astype(object) - np.array(self.over, object)
        return (z * z).sum(axis=1).tolist()


def _added(
    blocks: DataFrame, dimension: int, function: Callable[[np.ndarray], np.ndarray], rows: int, columns: int
) -> np.ndarray:
    """Sum of ``function`` (a rows x columns table per array of vectors) over all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rows, columns))
        for x in _arrays(batches, dimension):
            total += function(x)
        if total.any():
            cells = [pa.array(np.arange(total.size)), pa.array(total.reshape(-1))]
            yield pa.RecordBatch.from_arrays(cells, ["cell", "value"])

    cells = map_arrow(blocks, run, "cell long, value double", give_back=False)
    sums = cells.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(rows * columns)
    out[sums.column("cell").to_numpy()] = sums.column("value").to_numpy()
    return out.reshape(rows, columns)


def chebyshev(
    times: Callable[[np.ndarray], np.ndarray], block: np.ndarray, image: np.ndarray,
    cut: float, top: float, degree: int,
) -> np.ndarray:
    """The scaled Chebyshev polynomial of V on ``block``: small on [0, cut], growing up to ``top``.

    ``image`` is V times ``block``. Scaling by the polynomial's value at ``top`` keeps numbers small.
    """
    half = cut / 2
    first = scale = half / (top - half)
    before, now = block, (image - half * block) * (scale / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - scale)
        before, now = now, (times(now) - half * now) * (2 * after / half) - before * (scale * after)
        scale = after
    return now


def _ritz(block: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values by falling size, with the block and its image turned to the Ritz vectors."""
    inner = block.T @ image
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    turn = turn[:, ::-1]
    return np.maximum(values[::-1], 0), block @ turn, image @ turn


def _orthonormal(block: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.linalg.qr(block)[0])[0]


def leading_pairs(
    times: Callable[[np.ndarray], np.ndarray], dimension: int, wanted: int,
    guard: int = GUARD, degree: int = DEGREE,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Largest eigenvalues and unit eigenvectors (as rows) of V, certified, and the largest residual.

    ``times(Q)`` is V Q for a symmetric V without negative eigenvalues.
    """
    random = np.random.default_rng(42)
    size = min(dimension, wanted + guard)
    block = _orthonormal(random.standard_normal((dimension, size)))
    image = times(block)
    best = np.inf
    for _ in range(ROUNDS):
        values, block, image = _ritz(block, image)
        top = values[0]
        gaps = image[:, :wanted] - block[:, :wanted] * values[:wanted]
        residual = float(np.linalg.norm(gaps, axis=0).max()) / top if top > 0 else 0.0
        if residual <= CERTAIN or (residual <= ACCEPTED and residual > best / 2):
            missed = _missed(times, block, values, wanted, degree, random)
            if missed is None:
                return values[:wanted], block[:, :wanted].T, residual
            block = _orthonormal(np.hstack([block[:, :wanted], missed])[:, :size])
            image, best = times(block), np.inf
            continue
        best = min(best, residual)
        if values[-1] > NOTHING * top:
            block = chebyshev(times, block, image, values[-1], top, degree)
        else:
            # The block is larger than the rank: one product holds all of the range.
            block = image
        block = _orthonormal(block)
        image = times(block)
    raise RuntimeError(f"residual {best:.1e} after {ROUNDS} rounds")


def _missed(times, block, values, wanted, degree, random) -> np.ndarray | None:
    """Directions off the wanted ones with a larger eigenvalue; None if a filtered random block has none."""
    found, free = block[:, :wanted], block.shape[0] - wanted
    least = values[wanted - 1]
    if free <= 0 or values[0] <= 0:
        return None

    def off(columns: np.ndarray) -> np.ndarray:
        return columns - found @ (found.T @ columns)

    fresh = random.standard_normal((block.shape[0], min(free, max(1, block.shape[1] - wanted))))
    fresh = off(_orthonormal(off(fresh)))
    if least > NOTHING * values[0]:
        top = max(values[0], 1.01 * least)
        fresh = chebyshev(lambda q: off(times(q)), fresh, off(times(fresh)), least, top, degree)
    fresh = _orthonormal(off(fresh))
    others, fresh, _ = _ritz(fresh, times(fresh))
    return fresh if others[0] > least + 1e-9 * values[0] else None


def fit(blocks: DataFrame, dimension: int, wanted: int, guard: int = GUARD, degree: int = DEGREE) -> Whitening | None:
    """Components of the stored vectors; None without vectors."""
    n, total = _totals(blocks, dimension)
    if not n:
        return None
    centre = Centre(n, total)
    passes = 0

    def times(columns: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def product(x: np.ndarray) -> np.ndarray:
            y = centre(x)
            return y.T @ (y @ columns)

        return _added(blocks, dimension, product, *columns.shape) / n

    squares = _added(blocks, dimension, lambda x: (centre(x) ** 2).sum(axis=0)[:, None], dimension, 1)
    values, vectors, residual = leading_pairs(times, dimension, min(wanted, dimension), guard, degree)
    return Whitening(n, tuple(total), float(squares.sum() / n), values, vectors, residual, passes)


def identity_error(blocks: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    centre, projection = Centre(model.n, model.total), model.projection
    k = projection.shape[1]

    def moments(x: np.ndarray) -> np.ndarray:
        w = centre(x) @ projection
        return np.column_stack([w.T @ w, w.sum(axis=0)])

    sums = _added(blocks, model.dimension, moments, k, k + 1) / model.n
    covariance = sums[:, :k] - np.outer(sums[:, k], sums[:, k])
    useful = projection.any(axis=0)
    return float(np.abs(covariance - np.eye(k))[np.ix_(useful, useful)].max(initial=0))


def _whitened(model: Whitening, error: float):
    centre, projection, explained = Centre(model.n, model.total), model.projection, model.explained
    k = len(explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("embedding"), model.dimension)
            rows, w = len(x), centre(x) @ projection
            deviation = [Decimal(v) if v < 10**38 else None for v in centre.deviation(x)]
            each = pa.array(np.repeat(np.arange(rows), k), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n, np.int64)),
                    pa.array(deviation, pa.decimal128(38, 0)).take(each),
                    pa.array(w.reshape(-1)),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(vectors: DataFrame, wanted: int = 8, guard: int = GUARD, degree: int = DEGREE) -> DataFrame:
    """A row per vector of ``vectors`` (``vec_id, embedding``) and component, fitted on all of them.

    ``deviation`` is a decimal, null from 10^38 on.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    rows = usable(vectors.select("vec_id", "embedding"))
    dimension = usual_length(rows)
    rows = rows.where(F.size("embedding") == dimension)
    if not dimension:
        return vectors.sparkSession.createDataFrame([], schema)
    blocks = checkpointed(map_arrow(rows.select("embedding"), _blocks(dimension), "x binary"))
    model = fit(blocks, dimension, wanted, guard, degree)
    return map_arrow(rows, _whitened(model, identity_error(blocks, model)), schema)

"""Whitened embeddings: leading eigenvectors of the covariance by contour integration.

Vectors are laid on a grid of integers, so that counts, sums and products over all rows are exact and
do not depend on how Spark deals them out. Each distinct vector is fitted once. Tasks sum products of
the rows they hold; Spark adds these sums, one number for each pair of dimensions, and only they reach
the driver: what it holds grows with the square of the dimension, never with the rows.

There the filter of FEAST finds the leading components: an interval that holds them is bounded by
counting eigenvalues (inertia of the shifted matrix), complex shifted systems are solved at quadrature
nodes of a circle through its ends, and their weighted sum projects a random block onto the interval's
eigenvectors. A Rayleigh-Ritz step extracts them; the block is projected again until all residuals
vanish and as many pairs are found as the inertia says there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardline.llm.text import map_batches, materialise

#: Grid steps in a unit, and components returned at most.
GRID = 256
COMPONENTS = 4
#: Quadrature nodes on half of the circle; eigenvalues sought in one interval at most, but for ties.
NODES = 8
IN_INTERVAL = 8
#: Numbers that a task holds of a batch at a time.
BLOCK_ENTRIES = 1 << 20
_TOLERANCE = 1e-14
_EXACT = 1 << 53
_LARGEST = (1 << 63) - 1


# --- vectors on the grid ----------------------------------------------------------------


def grid_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows are usable, and their vectors' offsets and entries, floor(256 c), end to end.

    A row is usable unless its vector is null or has a null, infinite or undefined entry.
    """
    column = column.cast(pa.list_(pa.float64()))
    offsets = column.offsets.to_numpy().astype(np.int64)
    entries = column.values.to_numpy(zero_copy_only=False)  # nulls become NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
    size = np.where(usable, np.diff(offsets), 0)
    inside = np.repeat(offsets[:-1] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    steps = np.floor(GRID * entries[inside]) + 0
    # Beyond 64 bits the grid ends; such entries lie on its border.
    limit = float(1 << 62)
    return usable, np.concatenate([[0], np.cumsum(size[usable])]), np.clip(steps, -limit, limit).astype(np.int64)


def distinct_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """Each usable vector on the grid once (``x``), written below the scratch folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets, entries = grid_vectors(batch.column(0))
            x = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(entries))
            yield pa.RecordBatch.from_arrays([x], names=["x"])

    return materialise(map_batches(rows.select(f"`{vector}`"), run, "x array<bigint>").distinct(), "vectors")


def _blocks(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[np.ndarray]:
    """Vectors of column 0 as matrices of bounded size."""
    rows = max(1, BLOCK_ENTRIES // dimension)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.column(0).slice(start, rows)
            yield part.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _product(x: np.ndarray) -> np.ndarray:
    """x^T x of integers, exact, as Python integers."""
    top = int(max(x.max(initial=0), -x.min(initial=0), 1))
    if top * top > _EXACT // 2:
        wide = x.astype(object)
        return wide.T @ wide
    total, rows = np.zeros((x.shape[1], x.shape[1]), object), max(1, _EXACT // (top * top))
    for start in range(0, len(x), rows):
        part = x[start : start + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64)
    return total


@dataclass(frozen=True)
class Moments:
    """Number of fitted vectors, sums by dimension, and the covariance times n squared, all exact."""

    n: int
    sums: list[int]
    scaled: np.ndarray

    @property
    def covariance(self) -> np.ndarray:
        """Each entry rounded once, from whole numbers."""
        square = self.n * self.n
        return np.array([[v / square for v in row] for row in self.scaled.tolist()], np.float64)


def moments(vectors: DataFrame, dimension: int) -> Moments:
    """Moments of the distinct vectors of one dimension.

    A column of ones beside the vectors gives count and sums with the products. The covariance is
    formed as n * sum(x x') - sum(x) sum(x)' in whole numbers, which is n squared times that of
    centred vectors, without any rounding.
    """
    schema = "i int, j int, v decimal(38,0)"
    upper = np.triu_indices(dimension + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension + 1, dimension + 1), object)
        for x in _blocks(batches, dimension):
            total += _product(np.hstack([np.ones((len(x), 1), np.int64), x]))
        found = pa.array([Decimal(int(v)) for v in total[upper]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), found], names=["i", "j", "v"]
        )

    parts = map_batches(vectors.filter(F.size("x") == dimension), run, schema)
    added = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    whole = np.zeros((dimension + 1, dimension + 1), object)
    for i, j, v in zip(*(added.column(k).to_pylist() for k in range(3)), strict=True):
        whole[i, j] = whole[j, i] = int(v)
    n, sums = whole[0, 0], whole[0, 1:]
    return Moments(n, sums.tolist(), n * whole[1:, 1:] - np.outer(sums, sums))


# --- eigenvectors by contour integration -------------------------------------------------


class Inertia:
    """Counts eigenvalues of a symmetric matrix above any shift.

    The matrix is brought to three diagonals once, which keeps the inertia of every shift; a count
    is then the number of positive pivots of their elimination.
    """

    def __init__(self, matrix: np.ndarray):
        a, n = matrix.copy(), len(matrix)
        for k in range(n - 2):
            v = a[k + 1 :, k].copy()
            v[0] += np.copysign(np.linalg.norm(v), v[0])
            length = np.linalg.norm(v)
            if length == 0:
                continue
            v /= length
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = p - (v @ p) * v
            rest -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1, k] -= 2 * v[0] * (v @ a[k + 1 :, k])
        self._diagonal, beside = a.diagonal().copy(), np.abs(a.diagonal(-1))
        self._squares = np.concatenate([[0.0], beside**2]).tolist()
        around = np.concatenate([[0.0], beside]) + np.concatenate([beside, [0.0]])
        self.scale = float(np.max(np.abs(self._diagonal) + around))
        margin = 1e-10 * self.scale
        #: Bounds of all eigenvalues.
        self.low = float(np.min(self._diagonal - around)) - margin
        self.high = float(np.max(self._diagonal + around)) + margin

    def above(self, shift: float) -> int:
        least, pivot, count = np.finfo(float).eps * self.scale * 1e-3 + 1e-300, 1.0, 0
        for d, square in zip((self._diagonal - shift).tolist(), self._squares, strict=True):
            pivot = d - square / pivot
            if abs(pivot) < least:
                pivot = -least
            count += pivot > 0
        return count

    def place(self, k: int) -> float:
        """A shift just below the k-th largest eigenvalue."""
        low, high, close = self.low, self.high, 1e-13 * self.scale
        while high - low > close:
            middle = (low + high) / 2
            if not low < middle < high:
                break
            low, high = (middle, high) if self.above(middle) >= k else (low, middle)
        return low

    def cut(self, k: int) -> tuple[float, int]:
        """A shift in the gap below the k-th largest eigenvalue and its ties, and the count above."""
        margin, edge = 1e-12 * self.scale, self.place(k)
        while True:
            count = self.above(edge - margin)
            if count >= len(self._diagonal):
                return self.low, count
            following = self.place(count + 1)
            if edge - following > 4 * margin:
                return (edge + following) / 2, count
            edge = following  # equal but for rounding


def interval_pairs(matrix: np.ndarray, low: float, high: float, wanted: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """All eigenpairs with low < value < high, which inertia says are ``wanted``, by falling value."""
    n = len(matrix)
    knots, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(1j * np.pi / 2 * (1 - knots))
    middle, radius = (low + high) / 2, (high - low) / 2

    def projected(block: np.ndarray) -> np.ndarray:
        total = np.zeros_like(block)
        for turn, weight in zip(turns, weights, strict=True):
            shifted = (middle + radius * turn) * np.eye(n) - matrix
            total += (radius * turn * weight / 2 * np.linalg.solve(shifted, block)).real
        return total

    width = min(n, wanted + max(4, wanted // 2))
    while True:
        block = np.random.default_rng(7).standard_normal((n, width))
        best = None
        for _ in range(30):
            basis, _ = np.linalg.qr(projected(block))
            values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ inner
            residual = np.linalg.norm(matrix @ block - block * values, axis=0)
            right = (values > low) & (values < high) & (residual <= 1e-12 * scale)
            error = float(residual[right].max(initial=0)) if right.sum() == wanted else np.inf
            if best is not None and error >= best[0] / 2:
                break  # no longer improving: as exact as doubles allow
            if error < np.inf:
                best = (error, values[right][::-1], block[:, right][:, ::-1])
                if error <= _TOLERANCE * scale:
                    break
        if best is not None:
            return best[1], best[2]
        if width == n:
            raise ArithmeticError(f"{wanted} eigenvalues counted between {low} and {high}, others found")
        width = min(n, 2 * width)  # at n the block spans everything


def leading_pairs(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, falling, and unit eigenvectors as columns; none that are zero but for rounding."""
    n, trace = len(matrix), float(np.trace(matrix))
    inertia = Inertia(matrix)
    positive = inertia.above(max(n * np.finfo(float).eps * trace, 1e-300)) if trace > 0 else 0
    wanted = min(components, positive)
    values, vectors, high, found = [np.zeros(0)], [np.zeros((n, 0))], inertia.high, 0
    while found < wanted:
        low, count = inertia.cut(min(found + IN_INTERVAL, wanted))
        some, columns = interval_pairs(matrix, low, high, count - found, inertia.scale)
        values.append(some)
        vectors.append(columns)
        high, found = low, count
    return np.concatenate(values)[:wanted], np.hstack(vectors)[:, :wanted]


# --- the operator ------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """Fitted map: whitened = (x - mean) @ projection."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit to distinct vectors of the most frequent dimension (the smaller one where two are equally
    frequent); None if there is none."""
    common = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").filter("d > 0").first()
    if common is None:
        return None
    found = moments(vectors, common["d"])
    covariance = found.covariance
    values, columns = leading_pairs(covariance, components)
    return Whitening(found.n, found.sums, values, columns, float(np.trace(covariance)))


def identity_error(vectors: DataFrame, fitted: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, over the fit list."""
    dimension, mean, projection = len(fitted.sums), fitted.mean, fitted.projection
    k = projection.shape[1] + 1
    upper = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for x in _blocks(batches, dimension):
            white = np.hstack([np.ones((len(x), 1)), (x - mean) @ projection])
            total += white.T @ white
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(total[upper])], names=["i", "j", "v"]
        )

    parts = map_batches(vectors.filter(F.size("x") == dimension), run, "i int, j int, v double")
    whole = np.zeros((k, k))
    for i, j, v in parts.groupBy("i", "j").agg(F.sum("v")).collect():
        whole[i, j] = whole[j, i] = v / fitted.n
    covariance = whole[1:, 1:] - np.outer(whole[0, 1:], whole[0, 1:])
    return float(np.max(np.abs(covariance - np.eye(k - 1)), initial=0.0))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None where it exceeds 64 bits."""
    rough = ((n * x.astype(np.float64) - np.array(sums, np.float64)) ** 2).sum(axis=1)
    small = rough < 9.2e18 - 1e16  # then no step of the whole-number sum leaves 64 bits
    found: list[int | None] = [None] * len(x)
    if small.any():
        for i, v in zip(np.flatnonzero(small).tolist(), ((n * x[small] - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist(), strict=True):
            found[i] = v
    for i in np.flatnonzero(~small).tolist():
        exact = sum((n * v - s) ** 2 for v, s in zip(x[i].tolist(), sums, strict=True))
        found[i] = exact if exact <= _LARGEST else None
    return found


def whiten(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error of each usable row.

    Rows with a null vector, or one with null, infinite or undefined entries, are left out, and so are
    rows of another dimension than the most frequent one. Repeated rows and null keys stay as they are; ties
    of eigenvalues give any orthonormal vectors of their space, the same for all rows. Directions
    without variance have no component, so a table of equal vectors, and an empty one, give no rows.
    ``deviation`` is null where it exceeds 64 bits. Other columns are not read. Very long vectors are
    taken in blocks of rows; their dimension bounds what the driver holds.
    """
    kind = rows.schema[key].dataType.simpleString()
    spark = rows.sparkSession
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    vectors = distinct_vectors(rows, vector)
    fitted = fit(vectors, components)
    if fitted is None or not len(fitted.values):
        return spark.createDataFrame([], schema)
    error = identity_error(vectors, fitted)
    dimension, mean, projection = len(fitted.sums), fitted.mean, fitted.projection
    n, sums, found = fitted.n, fitted.sums, len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, BLOCK_ENTRIES // dimension)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                usable, offsets, entries = grid_vectors(part.column(1))
                size = np.diff(offsets)
                keys = part.column(0).filter(pa.array(usable)).filter(pa.array(size == dimension))
                x = entries[np.repeat(size == dimension, size)].reshape(-1, dimension)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(np.repeat(np.arange(len(x)), found))),
                        pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), len(x))),
                        pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), found))),
                        pa.array(((x - mean) @ projection).ravel()),
                    ],
                    names=[key, "component", "deviation", "whitened"],
                )

    white = map_batches(rows.select(f"`{key}`", f"`{vector}`"), run, f"`{key}` {kind}, component int, deviation bigint, whitened double")
    shares = F.array(*[F.lit(float(v / fitted.trace)) for v in fitted.values])
    return white.select(
        f"`{key}`",
        "component",
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("component")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )

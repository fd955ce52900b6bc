"""Whitening of embeddings: distributed covariance, its leading eigenvectors, broadcast projection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import table

SCALE, SHIFT = 64, 1_000_000  # an entry c becomes floor(SCALE * c) + SHIFT
FARTHEST = 2.0**52  # entries are held within this distance from zero, so their long form is exact
SLICE_CELLS = 1 << 20  # so many entries are worked on together
CLUSTER = 1e-3  # eigenvalues nearer than this part of the matrix's norm are made orthogonal to each other
EPS = np.finfo(float).eps


def usable(vector: Column) -> Column:
    """Whether a vector is there, and all its entries are finite numbers."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def longs(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, x of some rows as longs), slice by slice."""
    entries = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)
    step = max(1, SLICE_CELLS // dims)
    for a in range(0, len(entries), step):
        yield a, np.floor(SCALE * np.clip(entries[a : a + step], -FARTHEST, FARTHEST)).astype(np.int64) + SHIFT


def summed(rows: DataFrame, dims: int, width: int, kind: type, of) -> np.ndarray:
    """Sum of of(x) over all slices x of rows: an array of `width` rows of the same length.

    Each task sums its own slices; the rows of these sums are added up by their numbers.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in longs(batch, dims):
                part = of(x)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "r"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, r in zip(batch.column("i").to_pylist(), batch.column("r").to_pylist(), strict=True):
                part = np.frombuffer(r, kind)
                totals[i] = totals[i] + part if i in totals else part
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([r.tobytes() for r in totals.values()], pa.binary())], names=["i", "r"])

    parts = rows.select("vector").mapInArrow(partial, "i int, r binary").repartition(width, "i").mapInArrow(add, "i int, r binary")
    return np.array([np.frombuffer(r.r, kind) for r in sorted(parts.toLocalIterator(), key=lambda r: r.i)])


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, side diagonal, reflectors) of a symmetric matrix of entries up to 1, by Householder reflections."""
    a, n, reflectors = matrix.copy(), len(matrix), []
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        length = np.linalg.norm(v)
        if length < EPS * EPS:  # nothing to turn: the matrix's entries are 1 at most
            v[:] = 0
        else:
            v /= length
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = p - (v @ p) * v
            rest -= 2 * (np.outer(v, w) + np.outer(w, v))
            below = a[k + 1 :, k]
            below -= 2 * (v @ below) * v
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def below(diagonal: np.ndarray, squares: np.ndarray, at: np.ndarray, least: float) -> np.ndarray:
    """Sturm count: how many eigenvalues lie below each place."""
    count, d = np.zeros(len(at), int), np.ones(len(at))
    for k, own in enumerate(diagonal):
        d = own - at - (squares[k - 1] / d if k else 0)
        d = np.where(np.abs(d) < least, -least, d)
        count += d < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, side: np.ndarray, how_many: int) -> np.ndarray:
    """The largest eigenvalues of a tridiagonal matrix in falling order, by bisection on Sturm counts."""
    n = len(diagonal)
    reach = np.append(np.abs(side), 0) + np.append(0, np.abs(side))
    norm = np.max(np.abs(diagonal) + reach) or 1.0
    low, high = np.full(how_many, np.min(diagonal - reach) - norm * EPS), np.full(how_many, np.max(diagonal + reach) + norm * EPS)
    want, squares = n - 1 - np.arange(how_many), side**2
    for _ in range(200):
        middle = (low + high) / 2
        if not np.any((middle > low) & (middle < high)):
            break
        under = below(diagonal, squares, middle, norm * EPS * EPS) > want
        low, high = np.where(under, low, middle), np.where(under, middle, high)
    return (low + high) / 2


def _solved(diagonal: np.ndarray, side: np.ndarray, value: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solution of (T - value) x = right, by elimination with row exchanges."""
    n = len(diagonal)
    d, u, uu, b = (diagonal - value).tolist(), [*side.tolist(), 0.0], [0.0] * n, right.tolist()
    for k in range(n - 1):
        low, d1, u1 = float(side[k]), d[k + 1], u[k + 1]
        if abs(low) > abs(d[k]):
            d[k], u[k], uu[k], d1, u1, factor = low, d1, u1, u[k], uu[k], d[k] / low
            b[k], b[k + 1] = b[k + 1], b[k]
            d[k + 1], u[k + 1] = d1 - factor * u[k], u1 - factor * uu[k]
        else:
            factor = low / d[k] if d[k] else 0.0
            d[k + 1] = d1 - factor * u[k]
        b[k + 1] -= factor * b[k]
    x = [0.0] * (n + 2)
    for k in range(n - 1, -1, -1):
        pivot = d[k] if abs(d[k]) > least else least
        x[k] = (b[k] - u[k] * x[k + 1] - uu[k] * x[k + 2]) / pivot
    return np.array(x[:n])


def _block_vectors(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray, norm: float) -> np.ndarray:
    """Unit eigenvectors, as rows, of the given falling eigenvalues of a tridiagonal matrix without zeros in side."""
    n, start, found, first = len(diagonal), np.random.default_rng(7), [], 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        for _ in range(20):  # a start that leads to vectors already found is followed by another one
            x = start.standard_normal(n)
            for _ in range(4):
                x = _solved(diagonal, side, value, x / np.linalg.norm(x), EPS * norm)
                x /= np.linalg.norm(x)
                for other in found[first:] * 2:
                    x -= (other @ x) * other
                left = np.linalg.norm(x)
                if not left:
                    break
            if left > 0.01:
                break
        for other in found:
            x -= (other @ x) * other
        found.append(x / np.linalg.norm(x))
    return np.array(found)


def leading_eigenvectors(matrix: np.ndarray, how_many: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues in falling order, unit eigenvectors as columns) of a symmetric matrix.

    Householder reflections make it tridiagonal; where the side diagonal vanishes it falls
    into blocks.  Bisection finds the eigenvalues of each block, inverse iteration the
    vectors; those of eigenvalues that lie close together are made orthogonal to each other
    in each step.
    """
    n = len(matrix)
    scale = np.max(np.abs(matrix)) or 1.0
    diagonal, side, reflectors = tridiagonal(matrix / scale)
    norm = np.max(np.abs(diagonal)) + 2 * np.max(np.abs(side), initial=0) or 1.0
    cuts = [0, *(np.flatnonzero(np.abs(side) <= EPS * norm) + 1).tolist(), n]
    blocks = list(zip(cuts, cuts[1:]))
    found = [(v, a, b) for a, b in blocks for v in leading_eigenvalues(diagonal[a:b], side[a : b - 1], min(how_many, b - a))]
    found = sorted(found, key=lambda x: (-x[0], x[1]))[:how_many]
    values, vectors = np.array([v for v, _, _ in found]), np.zeros((n, len(found)))
    for a, b in blocks:
        own = [k for k, f in enumerate(found) if f[1] == a]
        if own:
            vectors[a:b, own] = _block_vectors(diagonal[a:b], side[a : b - 1], values[own], norm).T
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    return values * scale, vectors


def whiten(rows: DataFrame, components: int = 32, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row and component.

    An entry c counts as x = floor(64 * c) + 1000000.  All covariances are over all rows kept,
    with divisor n, centred before multiplying; components are the unit eigenvectors of that
    of x by falling eigenvalue.  Sums per dimension and deviations are exact longs; the driver
    gets matrices of dimensions * dimensions entries, whatever the number of rows.

    Left out: null and empty vectors, those with a null or non-finite entry, and those of
    another length than the most frequent one (of equally frequent ones the longest).
    Components without variance (constant columns, fewer rows than dimensions) are left out,
    as nothing can be divided by their zero; so fewer rows come out, or none.  Entries beyond
    2**52 count as that; a deviation that exceeds a long is null.  Repeated rows and null keys
    count as they come, with their null; equal eigenvalues take any base of their space.  An
    empty table gives no rows.  Other columns of rows aren't read.
    """
    spark = rows.sparkSession
    kept = rows.select(rows[key].alias("vec_id"), rows[vector].cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    lengths = kept.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("dims")).first()
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if most is None:
        return spark.createDataFrame([], out)
    dims, n = most.dims, most.n
    kept = kept.where(F.size("vector") == dims)
    sums = summed(kept, dims, 1, np.int64, lambda x: x.sum(axis=0, keepdims=True))[0]

    def centred(x: np.ndarray) -> np.ndarray:
        return (n * x - sums) / n

    covariance = summed(kept, dims, dims, np.float64, lambda x: centred(x).T @ centred(x)) / n
    trace = float(np.trace(covariance))
    values, vectors = leading_eigenvectors(covariance, components)
    there = values > trace * dims * EPS
    values, vectors = values[there], vectors[:, there]
    if not len(values):
        return spark.createDataFrame([], out)
    projection = vectors / np.sqrt(values)
    middle = summed(kept, dims, 1, np.float64, lambda x: (centred(x) @ projection).sum(axis=0, keepdims=True))[0] / n

    def spread(x: np.ndarray) -> np.ndarray:
        y = centred(x) @ projection - middle
        return y.T @ y

    error = float(np.max(np.abs(summed(kept, dims, len(values), np.float64, spread) / n - np.eye(len(values)))))
    return _projected(kept, spark.sparkContext.broadcast((n, sums, projection, values / trace, error)), out)


def _projected(kept: DataFrame, model, out: str) -> DataFrame:
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, projection, explained, error = model.value
        dims, width = projection.shape
        names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        for batch in batches:
            for first, x in longs(batch, dims):
                away = n * x - sums
                rough = (away.astype(float) ** 2).sum(axis=1)
                deviation = pa.array((away * away).sum(axis=1), mask=rough > 9.2e18)  # beyond a long: null
                repeat = pa.array(np.repeat(np.arange(len(x)), width))
                columns = [batch.column("vec_id").slice(first, len(x)).cast(pa.int64()).take(repeat), np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))]
                columns += [np.full(len(repeat), n), deviation.take(repeat), ((away / n) @ projection).ravel(), np.tile(explained, len(x)), np.full(len(repeat), error)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return kept.mapInArrow(project, out)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))

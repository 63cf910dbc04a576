"""Embedding whitening by a polarisation covariance.

Entries are whole numbers. For every dimension and every sum of two dimensions the tasks add up the exact squared
values, centred on a whole number near the mean; the rest of the mean is taken off exactly at the end. A cross-covariance
is half of what the variance of a sum has over the two variances. The matrix has one row per dimension and
goes to ``eigh`` on the driver; vectors never do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskloom.llm.tables import blocks, map_batches

#: Entry c becomes floor(64 c) + 1000000.
SCALE, SHIFT = 64, 1_000_000
#: A whole number's size at most: larger entries count as this, where a double still holds every one.
LARGEST = 2**53
COMPONENTS = 32
#: Entries of a block of vectors that a task holds as 64-bit numbers.
BLOCK = 500_000


@dataclass(frozen=True)
class Fit:
    """Count and sums of the vectors, and the components: unit vectors by falling eigenvalue, one a column."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def base(self) -> np.ndarray:
        """Whole numbers next to the means."""
        return np.array([s // self.n if self.n else 0 for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """n times what the means have over ``base``: from 0 to n - 1."""
        return [s - self.n * b for s, b in zip(self.sums, self.base.tolist())]


def _usable(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start in the values, values as doubles): the rows without a null or non-finite entry."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    flat = vectors.values
    values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
    offsets = vectors.offsets.to_numpy()
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = np.asarray(vectors.is_valid()) & (bad[offsets[1:]] == bad[offsets[:-1]])
    return np.flatnonzero(good), offsets, values


def _whole(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values * SCALE) + SHIFT, -LARGEST, LARGEST).astype(np.int64)


def _matrices(column: pa.Array, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, whole numbers): blocks of the usable vectors of ``dim`` entries."""
    rows, offsets, values = _usable(column)
    rows = rows[offsets[rows + 1] - offsets[rows] == dim]
    for low, high in blocks(np.full(len(rows), max(dim, 1)), BLOCK):
        part = rows[low:high]
        yield part, _whole(values[offsets[part][:, None] + np.arange(dim)])


def _roomy(matrix: np.ndarray, largest: int, sums: int) -> np.ndarray:
    """The matrix itself where sums of squares fit into 64 bits, else with Python's numbers."""
    return matrix if largest * largest * max(sums, 1) < 2**62 else matrix.astype(object)


def _largest(matrix: np.ndarray) -> int:
    return max(-int(matrix.min()), int(matrix.max()), 0) if matrix.size else 0


def dimension_of(rows: DataFrame, vector: str) -> int:
    """The commonest number of entries of usable vectors, the larger of equally common ones; 0 without any."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, offsets, _ = _usable(batch.column(0))
            size, times = np.unique(offsets[at + 1] - offsets[at], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(size.astype(np.int64)), pa.array(times.astype(np.int64))], ["size", "times"])

    found = map_batches(rows.select(vector), sizes, "size bigint, times bigint").groupBy("size").agg(F.sum("times").alias("times"))
    first = found.orderBy(F.desc("times"), F.desc("size")).first()
    return first["size"] if first else 0


def _totals(batches: Iterator[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    found: dict[int, list[int]] = {}
    for key, sums in batches:
        held = found.setdefault(key, [0] * len(sums))
        found[key] = [a + int(b) for a, b in zip(held, sums.tolist())]
    keys = [(k, i) for k, v in found.items() for i in range(len(v))]
    flat = [Decimal(x) for v in found.values() for x in v]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.int32()), pa.array([i for _, i in keys], pa.int32()), pa.array(flat, pa.decimal128(38, 0))], ["i", "j", "total"])


TOTALS = "i int, j int, total decimal(38,0)"


def _summed(rows: DataFrame, function) -> dict[tuple[int, int], int]:
    """Totals by pair of numbers over all tasks: as many as the matrix has entries, whatever the rows."""
    sums = map_batches(rows, function, TOTALS).groupBy("i", "j").agg(F.sum("total").alias("total"))
    return {(r.i, r.j): int(r.total) for r in sums.collect()}


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Fit:
    """Sums, covariance and components over all usable vectors of the commonest dimension.

    Components whose variance is nil to double precision are left out, as nothing can be scaled to unit variance along
    them. Each unit vector's entry of largest size is positive.
    """
    rows = rows.select(vector)
    dim = dimension_of(rows, vector)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[int, np.ndarray]]:
            for batch in batches:
                for _, x in _matrices(batch.column(0), dim):
                    x = x if _largest(x) * len(x) < 2**62 else x.astype(object)
                    yield 0, np.append(x.sum(0), len(x))

        yield _totals(parts())

    totals = _summed(rows, sums)
    n = totals.get((0, dim), 0)
    flat = Fit(n, [totals.get((0, i), 0) for i in range(dim)], np.zeros((dim, 0)), np.zeros(0), 0.0)
    if not n or not dim:
        return flat
    base = rows.sparkSession.sparkContext.broadcast(flat.base)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For (i, i) the squares of dimension i; for (i, j) those of the sum of i and j."""

        def parts() -> Iterator[tuple[int, np.ndarray]]:
            for batch in batches:
                for _, x in _matrices(batch.column(0), dim):
                    d = x - base.value
                    d = _roomy(d, 2 * _largest(d), len(d))
                    for i in range(dim):
                        pair = d[:, i:] + d[:, i : i + 1]
                        pair[:, 0] = d[:, i]
                        yield i, np.append(np.zeros(i, np.int64), (pair * pair).sum(0))

        yield _totals(parts())

    squared = _summed(rows, squares)
    rest = flat.rest

    def spread(i: int, j: int) -> int:
        """n squared times the variance of dimension i, or of the sum of two dimensions."""
        return n * squared[i, j] - (rest[i] if i == j else rest[i] + rest[j]) ** 2

    own = [spread(i, i) for i in range(dim)]
    cov = np.zeros((dim, dim))
    for i in range(dim):
        cov[i, i] = own[i] / (n * n)
        for j in range(i + 1, dim):
            cov[i, j] = cov[j, i] = (spread(i, j) - own[i] - own[j]) / (2 * n * n)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    kept = values > max(values[0], 0) * dim * np.finfo(float).eps
    values, vectors = values[kept], vectors[:, kept]
    top = vectors[np.abs(vectors).argmax(0), np.arange(len(values))]
    return Fit(n, flat.sums, vectors * np.where(top < 0, -1.0, 1.0), values, sum(own) / (n * n))


def _projected(x: np.ndarray, model: Fit, mean: np.ndarray) -> np.ndarray:
    return (x - model.base - mean) @ model.vectors / np.sqrt(model.values)


def _mean_rest(model: Fit) -> np.ndarray:
    return np.array([r / model.n for r in model.rest])


def identity_error(rows: DataFrame, model: Fit, vector: str = "embedding") -> float:
    """The largest entry of the covariance of the whitened vectors less the identity, measured over all of them."""
    k, dim = len(model.values), len(model.sums)
    if not k:
        return 0.0
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, total, moments = _mean_rest(shared.value), np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, x in _matrices(batch.column(0), dim):
                w = _projected(x, shared.value, mean)
                total += w.sum(0)
                moments += w.T @ w
        i, j = np.indices((k, k))
        columns = np.append(np.full(k, -1), i.ravel()), np.append(np.arange(k), j.ravel()), np.append(total, moments.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2])], ["i", "j", "total"])

    sums = map_batches(rows.select(vector), products, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    first, second = np.zeros(k), np.zeros((k, k))
    for r in sums.collect():
        if r.i < 0:
            first[r.j] = r.total / model.n
        else:
            second[r.i, r.j] = r.total / model.n
    return float(np.abs(second - np.outer(first, first) - np.eye(k)).max())


def whiten(rows: DataFrame, model: Fit, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector: id, ``deviation`` (decimal, exact) and ``whitened``, an array by component.

    Null, empty and non-finite vectors, and those of another dimension than the fit's, have no row; repeated rows and null
    ids stay. Other columns are not read.
    """
    shared, dim = rows.sparkSession.sparkContext.broadcast(model), len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean = _mean_rest(model) if model.n else np.zeros(dim)
        n, rest = shared.value.n, shared.value.rest
        for batch in batches:
            for at, x in _matrices(batch.column(1), dim if dim else -1):
                d = x - shared.value.base
                away = _roomy(d, n * (_largest(d) + 1), dim) * n - np.array(rest, np.int64)
                deviation = [Decimal(v) for v in (away * away).sum(1).tolist()]
                w = _projected(x, shared.value, mean)
                sizes = np.arange(len(at) + 1) * w.shape[1]
                listed = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(deviation, pa.decimal128(38, 0)), listed], [id_col, "deviation", "whitened"])

    chosen = rows.select(id_col, vector)
    return map_batches(chosen, run, f"`{id_col}` {chosen.schema[0].dataType.simpleString()}, deviation decimal(38,0), whitened array<double>")


def by_component(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: id, ``component`` from 1, ``n``, ``deviation`` (null beyond 64 bits),
    ``whitened``, ``explained`` and ``identity_error``. Without a component that varies there are no rows."""
    model = fit(rows, vector, components)
    error = identity_error(rows, model, vector)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    return whiten(rows, model, id_col, vector).select(id_col, F.expr("try_cast(deviation as bigint)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened")).select(
        id_col,
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )

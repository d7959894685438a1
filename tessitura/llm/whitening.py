"""Embedding whitening with a covariance from variances alone (polarisation).

Entries become integers, ``x = floor(1024 * c) + 100000``. For two dimensions
``2 Cov(i, j) = Var(x_i + x_j) - Var(x_i) - Var(x_j)``, so exact sums of squares of every
centred dimension and of every sum of two dimensions give the whole matrix. Three passes
read the vectors, each adds up inside its tasks and shuffles one row per sum and task:

1. their number and the sum of each dimension;
2. the squares. Vectors are centred before anything is multiplied: the mean rounded to an
   integer is taken off, and the rest of the mean, below one half, is a fraction with the
   divisor n that enters the exact result. All of it is integer arithmetic;
3. the products of the whitened values, which tell how far their covariance is from unity.

The driver gets one number per pair of dimensions (their count does not depend on the number
of rows) and calls ``eigh``. A fourth pass writes the result; nothing is shuffled there.

A vector that is null, holds a null or non-finite entry, or an entry whose x is beyond 2**52,
is dropped. So is a vector whose length is not the commonest one (of equally common lengths
the larger). Repeated vectors and ids, and null ids, are rows like any other. Components
whose variance is nothing but rounding are not returned, so equal vectors or an empty table
give no rows. Other columns are ignored.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Vectors that one step of a task works on.
SLICE = 4096
LARGEST = float(1 << 52)
SUMS = "a int, b int, total decimal(38,0)"


def integer_vectors(batch: pa.RecordBatch, length: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rows that count and their integer vectors (all of ``length``, if given)."""
    lists = batch.column("vec")
    start = lists.offsets.to_numpy()
    flat = lists.values.slice(start[0], start[-1] - start[0]).fill_null(np.nan).to_numpy(zero_copy_only=False)
    start = start - start[0]
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(SCALE * flat)
        bad = np.concatenate([[0], np.cumsum(~(np.abs(scaled) < LARGEST))])
    fine = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[start[1:]] == bad[start[:-1]])
    sizes = np.diff(start)
    if length is None:
        return np.flatnonzero(fine), sizes
    rows = np.flatnonzero(fine & (sizes == length))
    picked = scaled[start[rows][:, None] + np.arange(length)]
    return rows, picked.astype(np.int64) + OFFSET


def _vectors(vectors: DataFrame, column: str) -> DataFrame:
    return vectors.select(F.col(column).cast("array<double>").alias("vec"))


def _added(rows: DataFrame) -> dict[tuple[int, int], int]:
    """Exact totals per (a, b), one row each."""
    return {(r["a"], r["b"]): int(r["total"]) for r in rows.groupBy("a", "b").agg(F.sum("total").alias("total")).collect()}


def _sum_rows(totals: dict[tuple[int, int], int]) -> pa.RecordBatch:
    keys = list(totals)
    values = pa.array([totals[k] for k in keys], pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), values], ["a", "b", "total"])


def common_length(vectors: DataFrame, column: str) -> int | None:
    """The commonest length of usable vectors; the larger of equally common ones."""

    def run(batches):
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            rows, sizes = integer_vectors(batch, None)
            for size, n in zip(*np.unique(sizes[rows], return_counts=True)):
                seen[int(size), 0] = seen.get((int(size), 0), 0) + int(n)
        yield _sum_rows(seen)

    counts = _vectors(vectors, column).mapInArrow(run, SUMS).groupBy("a").agg(F.sum("total").alias("n"))
    best = counts.agg(F.max_by("a", F.struct("n", "a")).alias("a")).first()["a"]
    return best or None


def sums(vectors: DataFrame, column: str, length: int) -> tuple[int, list[int]]:
    """The number of vectors and the sum of each dimension."""

    def run(batches):
        n, total = 0, np.zeros(length, dtype=object)
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                _, x = integer_vectors(batch.slice(k, SLICE), length)
                n += len(x)
                total += _column_sums(x, 1)
        yield _sum_rows({(-1, -1): n, **{(d, d): int(v) for d, v in enumerate(total)}})

    found = _added(_vectors(vectors, column).mapInArrow(run, SUMS))
    return found[-1, -1], [found[d, d] for d in range(length)]


def _column_sums(x: np.ndarray, power: int) -> np.ndarray:
    """Exact sums of a power of each column, as Python integers where 64 bits could be too few."""
    most = int(np.abs(x).max(initial=0))
    if most**power * len(x) >= 1 << 62:
        x = x.astype(object)
    return np.asarray((x if power == 1 else x * x).sum(axis=0), dtype=object)


def squares(vectors: DataFrame, column: str, centre: list[int]) -> dict[tuple[int, int], int]:
    """Sums over ``y = x - centre``: of ``y_a`` under (a, -1), of its square under (a, a), of ``(y_a + y_b)`` squared under (a, b)."""
    length, middle = len(centre), np.array(centre, dtype=np.int64)

    def run(batches):
        plain = np.zeros(length, dtype=object)
        squared = [np.zeros(length - a, dtype=object) for a in range(length)]
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                _, x = integer_vectors(batch.slice(k, SLICE), length)
                y = x - middle
                plain += _column_sums(y, 1)
                for a in range(length):
                    pairs = y[:, a:] + y[:, a : a + 1]
                    pairs[:, 0] = y[:, a]
                    squared[a] += _column_sums(pairs, 2)
        out = {(a, -1): int(v) for a, v in enumerate(plain)}
        for a in range(length):
            out |= {(a, a + b): int(v) for b, v in enumerate(squared[a])}
        yield _sum_rows(out)

    return _added(_vectors(vectors, column).mapInArrow(run, SUMS))


@dataclasses.dataclass(frozen=True)
class Whitening:
    """A fitted transform: ``n`` vectors with sums ``total``, unit components as rows, their variances."""

    n: int
    total: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    @property
    def length(self) -> int:
        return len(self.total)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - total``, exact."""
        safe = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.total), default=0) < 1 << 62
        return x * self.n - np.array(self.total, dtype=np.int64) if safe else x.astype(object) * self.n - np.array(self.total, dtype=object)

    def project(self, x: np.ndarray) -> np.ndarray:
        around = (self.centred(x) / self.n).astype(np.float64)
        return around @ self.components.T / np.sqrt(self.variances)


def covariance(n: int, total: list[int], centre: list[int], found: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix, each entry rounded once from an exact fraction."""
    length = len(centre)
    rest = [s - n * m for s, m in zip(total, centre)]  # sums of y; below n / 2 each

    def spread(square: int, first: int) -> int:
        return n * square - first * first  # n * n times a variance

    alone = [spread(found[a, a], rest[a]) for a in range(length)]
    out = np.zeros((length, length))
    for a in range(length):
        out[a, a] = alone[a] / (n * n)
        for b in range(a + 1, length):
            both = spread(found[a, b], rest[a] + rest[b])
            out[a, b] = out[b, a] = (both - alone[a] - alone[b]) / (2 * n * n)
    return out


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors; None where there are none."""
    length = common_length(vectors, column)
    if length is None:
        return None
    n, total = sums(vectors, column, length)
    centre = [(2 * s + n) // (2 * n) for s in total]
    matrix = covariance(n, total, centre, squares(vectors, column, centre))
    values, axes = np.linalg.eigh(matrix)
    values, axes = values[::-1], axes[:, ::-1].T
    real = values > length * np.finfo(float).eps * max(values[0], 0)
    keep = np.flatnonzero(real)[:components]
    trace = float(np.trace(matrix))
    return Whitening(n, tuple(total), axes[keep].copy(), values[keep].copy(), values[keep] / trace if trace else values[keep])


def identity_error(vectors: DataFrame, column: str, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    k = len(model.variances)

    def run(batches):
        total = np.zeros((k, k))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                _, x = integer_vectors(batch.slice(at, SLICE), model.length)
                w = model.project(x)  # its mean is zero: x is centred
                total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), pa.array(total.ravel())], ["a", "total"])

    rows = _vectors(vectors, column).mapInArrow(run, "a int, total double").groupBy("a").agg(F.sum("total").alias("total"))
    unit = F.when(F.col("a") % (k + 1) == 0, 1.0).otherwise(0.0)
    return rows.agg(F.max(F.abs(F.col("total") / model.n - unit)).alias("e")).first()["e"]


def whiten(vectors: DataFrame, model: Whitening, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key, component, n, deviation, whitened, explained`` of every usable vector and component.

    ``deviation`` is the exact sum of ``(n * x - total)`` squared; null where a long is too small for it.
    """
    k = len(model.variances)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                piece = batch.slice(at, SLICE)
                rows, x = integer_vectors(piece, model.length)
                away = model.centred(x)
                if int(np.abs(away).max(initial=0)) ** 2 * model.length >= 1 << 62:
                    away = away.astype(object)
                far = [int(v) if v < 1 << 63 else None for v in (away * away).sum(axis=1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("key").take(pa.array(np.repeat(rows, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(rows) * k, model.n, dtype=np.int64)),
                        pa.array(far, pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                        pa.array(model.project(x).ravel()),
                        pa.array(np.tile(model.explained, len(rows))),
                    ],
                    ["key", "component", "n", "deviation", "whitened", "explained"],
                )

    kind = vectors.schema[key].dataType.simpleString()
    rows = vectors.select(F.col(key).alias("key"), F.col(column).cast("array<double>").alias("vec"))
    return rows.mapInArrow(run, f"key {kind}, component int, n long, deviation long, whitened double, explained double").withColumnRenamed("key", key)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(vectors)
    if model is None or not len(model.variances):
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    error = identity_error(vectors, "embedding", model)
    return whiten(vectors, model).withColumn("identity_error", F.lit(error))

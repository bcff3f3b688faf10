"""Whitening of embeddings on their leading components.

Vectors are fixed-point: whole numbers of 1/256. Over the distinct vectors, the
sums and the sums of products are taken exactly, in whole numbers: of products
after a whole number near the mean has been subtracted, and what is then left of
the mean is taken out exactly too. So the covariance is that of the centred
vectors, rounded once, whatever the order of the tasks. Its leading eigenpairs
come from spectrum slicing; they and the sums are all that travels back to the
rows. The driver holds matrices of the dimension of the vectors, no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.common import arrow_map
from tidyledger.llm.shared import written
from tidyledger.llm.spectrum import leading

SCALE = 256
COMPONENTS = 4
_LIMBS = 5  # sums travel as whole numbers to the base 2**30
_BITS = 30
_LONG = 2**63


def usable(vector: Column) -> Column:
    """Whether a vector is not null and holds only finite entries."""
    bad = F.exists(vector.cast("array<double>"), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~bad


def fixed_point(vector: Column) -> Column:
    """floor(256 * entry) of every entry, as a long; beyond a long's range its end."""
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(c * SCALE))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimension)


def _exact(x: np.ndarray, largest: int) -> np.ndarray:
    """`x` as it is if nothing computed of it is above 2**62, else as Python's whole numbers."""
    return x if largest < 2**62 else x.astype(object)


def _size(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def _sums(df: DataFrame, dimension: int, number: int, add: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """Exact sums of the `number` whole numbers that `add` gives for a matrix of some rows."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(number, object)
        for batch in batches:
            if batch.num_rows:
                total = total + add(matrix(batch.column("x"), dimension)).astype(object)
        some = np.flatnonzero(total)
        limbs = [(total[some] >> (_BITS * i)) & (2**_BITS - 1) for i in range(_LIMBS - 1)]
        limbs.append(total[some] >> (_BITS * (_LIMBS - 1)))
        columns = [pa.array(limb.astype(np.int64)) for limb in limbs]
        names = [f"l{i}" for i in range(_LIMBS)]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *columns], ["place", *names])

    schema = "place int, " + ", ".join(f"l{i} long" for i in range(_LIMBS))
    parts = arrow_map(df, compute, schema).groupBy("place")
    found = [0] * number
    for place, *limbs in parts.agg(*[F.sum(f"l{i}") for i in range(_LIMBS)]).collect():
        found[place] = sum(limb << (_BITS * i) for i, limb in enumerate(limbs))
    return found


@dataclass
class Whitening:
    """What the rows need: totals over the distinct vectors, eigenvalues and vectors (columns)."""

    dimension: int
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """x - S/n on every component, over the root of its eigenvalue."""
        return self.away(x).astype(np.float64) / self.n @ (self.vectors / np.sqrt(self.values))

    def away(self, x: np.ndarray) -> np.ndarray:
        """n * x - S."""
        largest = self.n * _size(x) + max(map(abs, self.sums), default=0)
        return _exact(x, largest) * self.n - np.array(self.sums, np.int64 if largest < 2**62 else object)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of the squares of n * x - S; None beyond the range of a long."""
        away = self.away(x)
        away = _exact(away, _size(away) ** 2 * self.dimension)
        return [v if v < _LONG else None for v in (away * away).sum(axis=1).tolist()]


def fit(df: DataFrame, vector_column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Whitening on the leading components of the covariance of all distinct vectors of `df`.

    Vectors that are null or hold null or non-finite entries do not count, nor do
    empty ones and those of another length than most (of two lengths as frequent,
    the shorter). Eigenvalues at rounding level give no component, so equal vectors
    or a table without rows have none.
    """
    vectors = df.filter(usable(F.col(vector_column))).select(fixed_point(F.col(vector_column)).alias("x"))
    # Copies are merged before the shuffle.
    distinct = written(vectors.filter(F.size("x") > 0).distinct(), "whitening")
    lengths = distinct.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return Whitening(0, 0, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    dimension = lengths["d"]
    distinct = distinct.filter(F.size("x") == dimension)

    def count(x: np.ndarray) -> np.ndarray:
        return np.append(_exact(x, _size(x) * len(x)).sum(axis=0), len(x))

    *sums, n = _sums(distinct, dimension, dimension + 1, count)
    # The whole numbers nearest to the mean.
    centre = [(2 * s + n) // (2 * n) for s in sums]
    upper = np.triu_indices(dimension)

    def products(x: np.ndarray) -> np.ndarray:
        largest = _size(x) + max(map(abs, centre))
        y = _exact(x, largest) - np.array(centre, np.int64 if largest < 2**62 else object)
        if _size(y) ** 2 * len(y) < 2**53:  # sums of doubles are exact up to there
            y = y.astype(np.float64)
            return np.append((y.T @ y)[upper].astype(np.int64), y.sum(axis=0).astype(np.int64))
        y = y.astype(object)
        return np.append((y.T @ y)[upper], y.sum(axis=0))

    found = _sums(distinct, dimension, len(upper[0]) + dimension, products)
    rest = found[len(upper[0]) :]
    covariance = np.zeros((dimension, dimension))
    for i, j, product in zip(*(u.tolist() for u in upper), found):
        covariance[i, j] = covariance[j, i] = (n * product - rest[i] * rest[j]) / (n * n)
    values, axes = leading(covariance, components)
    model = Whitening(dimension, n, sums, float(np.trace(covariance)), values, axes)
    model.identity_error = _identity_error(distinct, model)
    return model


def _identity_error(distinct: DataFrame, model: Whitening) -> float:
    """The largest entry of the covariance of the whitened vectors minus the identity."""
    k = len(model.values)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for batch in batches:
            w = model.whitened(matrix(batch.column("x"), model.dimension)) if batch.num_rows else np.zeros((0, k))
            total += w.T @ np.column_stack([w, np.ones(len(w))])
        places = pa.array(np.arange(total.size, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([places, pa.array(total.ravel())], ["place", "total"])

    if not k:
        return 0.0
    sums = arrow_map(distinct, compute, "place int, total double").groupBy("place").agg(F.sum("total"))
    total = np.zeros(k * (k + 1))
    for place, value in sums.collect():
        total[place] = value
    # The vectors are centred already; this takes out what rounding has left.
    total = total.reshape(k, k + 1) / model.n
    return float(np.abs(total[:, :k] - np.outer(total[:, k], total[:, k]) - np.eye(k)).max())


def transform(df: DataFrame, model: Whitening, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """For each row that counts and each component: the id, `component` (from 1), `n`,
    `deviation`, `whitened`, `explained` and `identity_error`.

    Rows that `fit` leaves out give none, and a model without components gives
    none at all. Repeated rows stay rows; null ids stay null. Other columns are
    not read.
    """
    k = len(model.values)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows or not k:
                continue
            x = matrix(batch.column("x"), model.dimension)
            each = pa.array(np.repeat(np.arange(rows), k))
            deviation = pa.array(model.deviation(x), pa.int64())
            columns = [
                batch.column("_id").take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.n)),
                deviation.take(each),
                pa.array(model.whitened(x).ravel()),
                pa.array(np.tile(model.values / model.trace, rows)),
                pa.array(np.full(rows * k, model.identity_error)),
            ]
            names = ["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = df.schema[id_column].dataType.simpleString()
    rows = df.filter(usable(F.col(vector_column))).select(
        F.col(id_column).alias("_id"), fixed_point(F.col(vector_column)).alias("x")
    )
    schema = f"_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = arrow_map(rows.filter(F.size("x") == model.dimension), compute, schema)
    return found.withColumnRenamed("_id", id_column)

"""Whitening of embeddings: centred covariance over all rows, its leading components, and a broadcast projection.

Tasks add up whole numbers first and centred products next; what reaches the
driver is one matrix of the vectors' dimensions. The eigenpairs found there
are sent to all tasks, which project every row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.batches import map_batches
from roomledger.llm.eigen import EPS, leading_eigenpairs

COMPONENTS = 32
STEPS = 64  # steps an entry of 1.0 is cut into
OFFSET = 1000000
LARGEST = float(1 << 46)  # entries from here on count as not finite: their steps and a batch's sum must be whole numbers of 63 bits
DIMENSIONS = 4096  # bound of the matrix that the driver solves
OWN = ["n", "deviation", "whitened", "explained", "identity_error"]


class Whitening(NamedTuple):
    """What is learned from all rows."""

    n: int
    sums: list[int]  # per dimension, of the whole-number entries
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # their unit vectors in columns
    trace: float

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def weights(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def usable(vector: Column) -> Column:
    """Vectors without null or non-finite entries."""
    return F.coalesce(
        vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST)), F.lit(False)
    )


def whole_steps(batch: pa.RecordBatch, vector: str, dimensions: int) -> np.ndarray:
    """The vectors of a batch as whole numbers, a row each."""
    entries = batch.column(vector).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(STEPS * entries).astype(np.int64) + OFFSET).reshape(batch.num_rows, dimensions)


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Quotients and remainders of the sums by n: x - quotient is whole, the remainder's share below one."""
    return np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)


def _centred(steps: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    quotient, remainder = _centre(n, sums)
    return (steps - quotient) - remainder / n


def _sums(rows: DataFrame, vector: str, dimensions: int) -> tuple[int, list[int]]:
    """Rows and the exact sum of every dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dimensions, object)
        for batch in batches:
            n += batch.num_rows
            total = total + whole_steps(batch, vector, dimensions).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({
                "at": pa.array(range(dimensions), pa.int32()), "n": pa.array([n] * dimensions, pa.int64()),
                "total": pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)),
            })

    parts = map_batches(rows, add, "at int, n long, total decimal(38,0)")
    found = parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("at").collect()
    return found[0]["n"] if found else 0, [int(r["total"]) for r in found]


def _products(rows: DataFrame, numbers: Callable[[pa.RecordBatch], np.ndarray], width: int) -> np.ndarray:
    """The sum over all rows of the outer products of centred ``numbers``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            each = numbers(batch)
            total = each.T @ each if total is None else total + each.T @ each
        if total is not None:
            yield pa.RecordBatch.from_pydict({
                "at": pa.array(range(width), pa.int32()), "line": pa.array(total.tolist(), pa.list_(pa.float64())),
            })

    parts = map_batches(rows, add, "at int, line array<double>")
    entries = parts.select("at", F.posexplode("line").alias("across", "value"))
    found = entries.groupBy("at", "across").agg(F.sum("value").alias("value")).toPandas()
    matrix = np.zeros((width, width))
    matrix[found["at"], found["across"]] = found["value"]
    return matrix


def fit_rows(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """The rows that can be whitened, and the dimensions of their vectors.

    Vectors that are null or hold entries that are null or not finite go, as
    do those of another length than most (of the longer, if two are as
    frequent): they have no place in the covariance.
    """
    kept = rows.filter(usable(F.col(vector)))
    lengths = kept.groupBy(F.size(vector).alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    dimensions = most["length"] if most else 0
    if dimensions > DIMENSIONS:
        raise ValueError(f"vectors of {dimensions} dimensions; the driver solves {DIMENSIONS} at most")
    return kept.filter((F.size(vector) == dimensions) & (F.size(vector) > 0)), dimensions


def fit_whitening(rows: DataFrame, dimensions: int, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Learn from all rows of ``fit_rows``; components without variance are left out."""
    only = rows.select(vector)
    n, sums = _sums(only, vector, dimensions)
    if not n:
        return Whitening(0, [0] * dimensions, np.zeros(0), np.zeros((dimensions, 0)), 0.0)
    covariance = _products(only, lambda batch: _centred(whole_steps(batch, vector, dimensions), n, sums), dimensions) / n
    values, vectors = leading_eigenpairs(covariance, components)
    real = values > 4 * dimensions * EPS * (values[0] if len(values) else 0.0)
    return Whitening(n, sums, values[real], vectors[:, real], float(np.trace(covariance)))


def identity_error(rows: DataFrame, model: Whitening, vector: str = "embedding") -> float | None:
    """The largest entry of the whitened rows' covariance minus the identity; None without components."""
    width = len(model.values)
    if not width:
        return None
    weights = model.weights()

    def whitened(batch: pa.RecordBatch) -> np.ndarray:
        return _centred(whole_steps(batch, vector, model.dimensions), model.n, model.sums) @ weights

    return float(np.abs(_products(rows.select(vector), whitened, width) / model.n - np.eye(width)).max())


def _deviation(steps: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S) squared; None beyond 63 bits."""
    quotient, remainder = _centre(n, sums)
    away = steps - quotient
    if (np.abs(away).max(initial=0) + 1.0) * n < 2.0 ** 31 / np.sqrt(steps.shape[1]):
        return ((n * away - remainder) ** 2).sum(axis=1).tolist()
    exact = [sum((n * a - r) ** 2 for a, r in zip(row, remainder.tolist())) for row in away.tolist()]
    return [d if d < 1 << 63 else None for d in exact]


def project(rows: DataFrame, model: Whitening, error: float | None, vector: str = "embedding") -> DataFrame:
    """Every row of ``rows`` with ``OWN``: the projection by the model, sent to all tasks."""
    kept = [c for c in rows.columns if c not in OWN]
    schema = T.StructType([
        *(rows.schema[c] for c in kept), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("explained", T.ArrayType(T.DoubleType())),
        T.StructField("identity_error", T.DoubleType()),
    ])
    weights = model.weights()
    explained = (model.values / model.trace).tolist() if model.trace else []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_here = batch.num_rows
            steps = whole_steps(batch, vector, model.dimensions)
            found = _centred(steps, model.n, model.sums) @ weights
            own = [
                pa.array([model.n] * rows_here, pa.int64()), pa.array(_deviation(steps, model.n, model.sums), pa.int64()),
                pa.array(found.tolist(), pa.list_(pa.float64())), pa.array([explained] * rows_here, pa.list_(pa.float64())),
                pa.array([error] * rows_here, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *own], [*kept, *OWN])

    return map_batches(rows.select(*kept), work, schema)


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whiten the vectors of all rows by up to ``components`` leading components of their own covariance.

    Entries c become the whole numbers x = floor(64 c) + 1000000. Returns the
    rows of ``fit_rows`` with ``OWN``; columns of the input by these names give
    way. ``n`` counts these rows, ``deviation`` is the exact sum of
    (n x - S)^2 over the dimensions (null beyond a long), ``whitened`` the
    centred x on each unit component over the root of its eigenvalue,
    ``explained`` the components' shares of the variance, ``identity_error``
    how far the covariance of ``whitened`` is from the identity. Components
    without variance (constant or dependent dimensions, fewer rows) are left
    out; a single row, or equal rows only, have an empty list. Repeated rows
    count each; null ids are kept; an empty table, or one without a usable
    vector, gives an empty result.
    """
    fitted, dimensions = fit_rows(rows, vector)
    model = fit_whitening(fitted, dimensions, vector, components)
    return project(fitted, model, identity_error(fitted, model, vector), vector)


def whitened_components(rows: DataFrame) -> DataFrame:
    """A row for each row of an ``embeddings`` table that is not dropped and each of its components."""
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "of")
    return whiten(rows.select("vec_id", "embedding")).select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", F.col("of.whitened").alias("whitened"),
        F.col("of.explained").alias("explained"), "identity_error",
    )

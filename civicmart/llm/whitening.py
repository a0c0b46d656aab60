"""PCA whitening of embeddings, the spectrum taken by slicing (``spectrum``).

Entries c become the whole numbers x = floor(scale * c) + offset, so sums are exact and every
task order gives the same means. Two passes over the vectors gather what the fit needs:

1. their number and the sum of each dimension (exact, whole numbers);
2. the products of centred entries: x minus the whole part of the mean is exact, its remainder
   is taken off as a double, and only then is multiplied. Tasks add up one triangle of
   products each, which Spark sums by place: d * (d + 1) / 2 numbers reach the driver, whatever
   the number of vectors.

The driver finds the leading eigenpairs; a third pass measures how far the covariance of the whitened
vectors is from the identity. All vectors are fitted.

Defined results: rows whose vector is null or empty, or holds a null or non-finite entry or one that scaled passes 2^53,
are left out; so are vectors of another length than most (of equally frequent lengths the largest
counts). A null id is an id like others, repeated rows are rows each. Directions without
variance beyond rounding (all of them for a single vector) can't be whitened and aren't returned, so a
row then has fewer components; an empty table gives an empty result. ``deviation`` is null where it
passes the range of a long. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.llm.common import scratch, stored
from civicmart.llm.spectrum import leading
from civicmart.llm.tokenize import batches

COMPONENTS, SCALE, OFFSET = 32, 64, 1_000_000
BATCH = 4096
LARGEST = float(1 << 53)


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: (x - sums / n) @ axes / sqrt(values)."""

    n: int
    sums: list[int]          # of each dimension
    values: np.ndarray       # eigenvalues, falling
    axes: np.ndarray         # unit eigenvectors as columns
    trace: float

    @property
    def explained(self) -> list[float]:
        return (self.values / self.trace).tolist() if len(self.values) else []


def usable(vector: Column) -> Column:
    """Whether a vector has entries, all of them there and finite."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda c: c.isNotNull() & (F.abs(c.cast("double") * SCALE) < F.lit(LARGEST)))


def whole_numbers(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x): usable vectors of the usual length, as whole numbers."""
    picked = rows.select(F.col(key).alias("key"), F.col(vector).alias("v")).where(usable(F.col("v")))
    sizes = picked.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return picked.where(F.size("v") == (sizes.d if sizes else 0)).select("key", F.transform(
        "v", lambda c: F.floor(c.cast("double") * SCALE) + OFFSET).alias("x"))


def _matrices(tables):
    """(key column, whole numbers as a matrix) of each batch."""
    for table in tables:
        for part in batches(table, BATCH):
            x = part.column("x")
            x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
            if len(x):
                yield part.column("key"), x.flatten().to_numpy().reshape(len(x), -1)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit all rows of ``vectors`` (x: whole numbers, of one length)."""

    def add(it):
        n, sums = 0, None
        for _, x in _matrices(it):
            sums = x.sum(axis=0).astype(object) if sums is None else sums + x.sum(axis=0)
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, len(sums)), pa.int32()), pa.array([str(v) for v in (n, *sums)], pa.string())],
                names=["i", "v"])

    rows = vectors.mapInArrow(add, "i int, v string").groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).orderBy("i").collect()  # one a dimension
    n, *sums = [int(r.v) for r in rows] or [0]
    d = len(sums)
    if not n:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)

    def products(it):
        total = np.zeros((d, d))
        for _, x in _matrices(it):
            c = _centred(x, n, sums)
            total += c.T @ c
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                          pa.array(total[i, j])], names=["i", "j", "v"])

    matrix = np.zeros((d, d))
    for r in vectors.mapInArrow(products, "i int, j int, v double").groupBy("i", "j").agg(
            F.sum("v").alias("v")).collect():  # d * (d + 1) / 2 rows
        matrix[r.i, r.j] = matrix[r.j, r.i] = r.v / n
    values, axes = leading(matrix, components)
    real = values > 8 * d * np.finfo(float).eps * (values[0] if len(values) else 0.0)
    return Whitening(n, sums, values[real], axes[:, real], float(np.trace(matrix)))


def identity_error(vectors: DataFrame, fitted: Whitening) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    k = len(fitted.values)
    if not k:
        return None
    n, sums, to = fitted.n, fitted.sums, fitted.axes / np.sqrt(fitted.values)

    def products(it):
        total = np.zeros((k, k))
        for _, x in _matrices(it):
            y = _centred(x, n, sums) @ to
            total += y.T @ y
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array((i * k + j).astype(np.int32)), pa.array(total[i, j])],
                                         names=["at", "v"])

    row = vectors.mapInArrow(products, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).agg(
        F.max(F.abs(F.col("v") / n - F.when(F.col("at") % (k + 1) == 0, 1.0).otherwise(0.0))).alias("e")).first()
    return row.e


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * x - S)^2 of each row, exact; None beyond a long."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=object)
    off = x - whole
    most = n * (int(np.abs(off).max()) + 1)
    if most * most * x.shape[1] < 1 << 63:
        own = n * off - rest.astype(np.int64)
        return (own * own).sum(axis=1).tolist()
    own = off.astype(object) * n - rest
    return [int(v) if v < 1 << 63 else None for v in (own * own).sum(axis=1)]


def transform(vectors: DataFrame, fitted: Whitening) -> DataFrame:
    """(key, deviation, whitened): the whitened vector of each row, and its exact squared distance times n^2."""
    n, sums = fitted.n, fitted.sums
    to = fitted.axes / np.sqrt(fitted.values) if len(fitted.values) else None

    def run(it):
        for key, x in _matrices(it):
            y = _centred(x, n, sums) @ to if to is not None else np.zeros((len(x), 0))
            at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * y.shape[1])
            yield pa.RecordBatch.from_arrays(
                [key.combine_chunks() if isinstance(key, pa.ChunkedArray) else key,
                 pa.array(_deviations(x, n, sums), pa.int64()), pa.ListArray.from_arrays(at, pa.array(y.ravel()))],
                names=["key", "deviation", "whitened"])

    kind = vectors.schema["key"].dataType.simpleString()
    return vectors.mapInArrow(run, f"key {kind}, deviation long, whitened array<double>")


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> tuple[DataFrame, Whitening, float | None]:
    """Whitened vectors (key, deviation, whitened) of ``rows``, the fit, and its identity error."""
    vectors = stored(whole_numbers(rows, key, vector), scratch(rows.sparkSession, "whitening"))
    fitted = fit(vectors, components)
    return transform(vectors, fitted), fitted, identity_error(vectors, fitted)

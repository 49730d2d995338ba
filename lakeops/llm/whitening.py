"""Embedding whitening by a weighted multiplicity covariance.

Vectors are turned into integers, and identical integer vectors are grouped with
the number of their rows.  Each distinct vector enters the fit once with a weight,
its count or one: sums first, then partial products of the weighted centred vectors
(one matrix product a batch), added up over all tasks.  The eigenvectors of that
covariance whiten every distinct vector once, and the result is joined back to the
rows.

Sums and deviations are exact integers.  Only the sums, the covariance and the
components come to the driver: their size depends on the dimensions, not on the
rows.  At most ``1 / HOT`` vectors can each be that share of all rows; these few are
broadcast to the rows, so that copies of one vector never meet in one task.

Nulls and edges: a vector that is null, empty or holds null or non-finite entries is
dropped, and so is one with an entry whose integer does not fit a long; of vectors of
different lengths the most frequent length stays (of equally frequent ones the
longer).  Rows with a null id and repeated rows are whitened like any other.  A
component without variance (one distinct vector, or fewer vectors than dimensions)
has null values and is left out of the identity error; a deviation that does not fit
38 digits is null.  An empty table gives an empty result.  Only the two named
columns are read, so clashing names of others do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import materialise

# Entries become floor(SCALE * c) + SHIFT (fixed values).
SCALE, SHIFT = 64, 1_000_000
# The share of all rows from which the copies of a vector are joined by broadcast.
HOT = 1 / 1000
# Eigenvalues below this share of the largest, times the dimensions, are no variance.
_NOTHING = 1e-13
# Integers up to this stay exact in a long when added or multiplied as below.
_SAFE = 1 << 62


def usable(vector: Column) -> Column:
    """All entries finite, and their integers within a long."""
    fits = lambda c: F.coalesce(F.abs(c.cast("double")) < float(1 << 56), F.lit(False))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, fits), F.lit(False))


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("bigint"))


@dataclass
class Fit:
    """What whitening needs: all of it sized by the dimensions."""

    n: int  # fit weight in total
    sums: list[int]
    components: np.ndarray  # a row each, unit length, by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if self.trace > 0 else np.zeros(len(self.eigenvalues))

    @property
    def varied(self) -> np.ndarray:
        least = _NOTHING * len(self.sums) * self.eigenvalues.max(initial=0)
        return self.eigenvalues > max(least, 0)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _exact(x: np.ndarray, most: int) -> np.ndarray:
    """As longs where results up to ``most`` fit one, else as Python integers."""
    return x if most < _SAFE else x.astype(object)


def _off_centre(x: np.ndarray, n: int, sums: list[int], largest: int) -> np.ndarray:
    """``n * x - sums``, exactly."""
    safe = 2 * n * largest < _SAFE
    return _exact(x, 0 if safe else _SAFE) * n - np.array(sums, np.int64 if safe else object)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``(key, x, count)`` of ``rows(key, x)``; equal vectors have equal keys."""
    return rows.groupBy("key").agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("count"))


def fit(distinct: DataFrame, top: int = 16, weights: str = "one") -> Fit | None:
    """Sums, covariance and components of the distinct vectors, weighted by ``one`` or by ``count``."""
    if weights not in ("one", "count"):
        raise ValueError("weights must be 'one' or 'count'")
    weight = F.lit(1).cast("bigint") if weights == "one" else F.col("count")
    weighed = distinct.select("x", weight.alias("w"))
    shape = weighed.agg(F.max(F.size("x")).alias("dims"), F.sum("w").alias("n"),
                        F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x")))).alias("largest")).first()
    if not shape.n:
        return None
    dims, n, largest = shape.dims, int(shape.n), int(shape.largest)

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, object)
        for batch in batches:
            w = batch.column(1).to_numpy()
            x = _exact(_matrix(batch.column(0), dims), largest * int(w.sum()))
            total = total + (x * w[:, None]).sum(0)
        yield pa.record_batch([pa.array(range(dims), pa.int32()), pa.array(total.tolist(), pa.decimal128(38))], ["i", "s"])

    sums = [int(r.s) for r in weighed.mapInArrow(sums_of, "i int, s decimal(38,0)").groupBy("i")
            .agg(F.sum("s").alias("s")).orderBy("i").collect()]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            centred = _off_centre(_matrix(batch.column(0), dims), n, sums, largest).astype(float) / n
            total += (centred * batch.column(1).to_numpy()[:, None]).T @ centred
        yield _entries(total)

    covariance = _gathered(weighed.mapInArrow(products, _ENTRIES), dims) / n
    values, columns = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:top]
    return Fit(n, sums, np.ascontiguousarray(columns[:, order].T), np.maximum(values[order], 0), float(np.trace(covariance)))


_ENTRIES = "i int, j int, v double"


def _entries(matrix: np.ndarray) -> pa.RecordBatch:
    i, j = np.indices(matrix.shape).reshape(2, -1)
    return pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(matrix.ravel())], ["i", "j", "v"])


def _gathered(entries: DataFrame, dims: int) -> np.ndarray:
    out = np.zeros((dims, dims))
    for r in entries.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = r.v
    return out


def whiten_distinct(distinct: DataFrame, model: Fit) -> DataFrame:
    """``(key, count, deviation, whitened)``: each distinct vector whitened once."""
    dims, n, sums, varied = len(model.sums), model.n, model.sums, model.varied
    scaled = model.components[varied] / np.sqrt(model.eigenvalues[varied])[:, None]
    places, k = np.flatnonzero(varied), len(model.components)
    most = 10 ** 38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            off = _off_centre(x, n, sums, int(np.abs(x.astype(float)).max(initial=0)) + 1 if len(x) else 1)
            furthest = int(np.abs(off).max()) if off.size else 0
            deviation = (_exact(off, dims * furthest * furthest) ** 2).sum(1)
            white = np.full((len(x), k), np.nan)
            white[:, places] = (off.astype(float) / n) @ scaled.T
            yield pa.record_batch(
                [batch.column(0), batch.column(2),
                 pa.array([int(d) if d < most else None for d in deviation], pa.decimal128(38)),
                 pa.array([[None if np.isnan(v) else v for v in row] for row in white.tolist()], pa.list_(pa.float64()))],
                ["key", "count", "deviation", "whitened"])

    return distinct.select("key", "x", "count").mapInArrow(
        run, "key binary, count bigint, deviation decimal(38,0), whitened array<double>")


def identity_error(white: DataFrame, model: Fit, weights: str = "one") -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    places = np.flatnonzero(model.varied)
    if not len(places):
        return None
    k, n = len(places), model.n
    weight = F.lit(1).cast("bigint") if weights == "one" else F.col("count")
    rows = white.select(F.array(*[F.col("whitened")[int(p)] for p in places]).alias("z"), weight.alias("w"))
    mean = np.array(rows.agg(*[F.sum(F.col("z")[i] * F.col("w")) for i in range(k)]).first(), float) / n

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            centred = _matrix(batch.column(0), k) - mean
            total += (centred * batch.column(1).to_numpy()[:, None]).T @ centred
        yield _entries(total)

    return float(np.abs(_gathered(rows.mapInArrow(products, _ENTRIES), k) / n - np.eye(k)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", top: int = 16,
           weights: str = "one") -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``: a row per row and component."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = (vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v")))
            .select("id", integers(F.col("v")).alias("x")))
    # A digest stands for the vector: equal vectors meet by it, and rows need not carry theirs.
    rows = materialise(rows.select("id", F.unhex(F.sha2(F.array_join(F.col("x").cast("array<string>"), ","), 256)).alias("key"),
                                   "x"), "whitening-rows")
    lengths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None:
        return spark.createDataFrame([], f"id {kind}, {_RESULT}")
    rows, total = rows.where(F.size("x") == lengths.dims), lengths["count"]
    distinct = materialise(distinct_vectors(rows), "whitening-distinct")
    model = fit(distinct, top, weights)
    white = materialise(whiten_distinct(distinct, model), "whitening-white")
    error = identity_error(white, model, weights)
    values = ["deviation", "whitened"]
    is_hot = F.col("count") >= HOT * total
    hot = white.where(is_hot).select("key", *[F.col(c).alias(f"hot_{c}") for c in values], F.lit(True).alias("hot"))
    tried = rows.select("id", "key").join(F.broadcast(hot), "key", "left")  # at most 1 / HOT vectors
    joined = (tried.where("hot").select("id", *[F.col(f"hot_{c}").alias(c) for c in values])
              .unionByName(tried.where("hot is null").select("id", "key")
                           .join(white.where(~is_hot).select("key", *values), "key").select("id", *values)))
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    return (joined.select("id", "deviation", F.posexplode("whitened").alias("c", "whitened"))
            .select("id", (F.col("c") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"),
                    "deviation", "whitened", explained[F.col("c")].alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")))


_RESULT = ("component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")

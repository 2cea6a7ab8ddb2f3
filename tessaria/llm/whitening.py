"""Whitening of embeddings by a two-pass covariance.

Entries become whole numbers, so that the first pass sums them exactly. The second pass centres each
block of vectors and multiplies it with itself (one GEMM a block); the tasks' matrices are merged by
``treeAggregate``. The driver takes the eigenvectors of one matrix of dimensions by dimensions
(LAPACK), and the projection, as small, is broadcast. One more pass measures the whitened vectors'
own covariance. No pass shuffles vectors, and what a task or the driver holds depends on the
dimensions, not on the number of vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessaria.llm.common import table

#: The most components, the whole numbers a unit has, and what is added to them.
COMPONENTS, UNITS, OFFSET = 32, 64.0, 1_000_000
#: Entries beyond this are no whole numbers of 64 bits once scaled: their vectors are left out.
LARGEST = 2.0**56
#: Directions whose variance is no more than rounding (this times dimensions and the largest variance) have no scale.
EPSILON = 2.0**-52
#: Levels of the tree that merges the tasks' sums.
DEPTH = 3


def usable(df: DataFrame, vec_col: str) -> DataFrame:
    """Rows of ``df`` whose vector can be whitened, as (vec, its length): not null, without null or non-finite entries."""
    v = F.col(vec_col)
    fine = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)) & ~F.isnan(c.cast("double")))
    return df.filter(v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a batch as whole numbers, a row each."""
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
    return np.floor(UNITS * flat).astype(np.int64) + OFFSET


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exactly: 64-bit numbers where they are large enough, else Python's."""
    if n * (int(np.abs(x).max(initial=0)) + 1) * 2 < 2**63:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _squares(d: np.ndarray) -> list[int]:
    """The sum of each row's squares, exactly."""
    if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * max(d.shape[1], 1) < 2**63:
        return np.einsum("ij,ij->i", d, d).tolist()
    return [sum(int(v) * int(v) for v in row) for row in d]


def _sums_of(dims: int) -> Callable:
    """The first pass in a task: how many vectors, and the sum of each dimension in two halves that can't overflow."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for b in batches:
            x = _matrix(b.column(0), dims)
            n += len(x)
            high, low = (x >> 31).sum(axis=0), (x & (2**31 - 1)).sum(axis=0)
            total = [t + (int(h) << 31) + int(k) for t, h, k in zip(total, high, low, strict=True)]
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "sums": pa.array([[str(t) for t in total]], pa.list_(pa.string()))})

    return run


def _products_of(dims: int, centred: Callable[[np.ndarray], np.ndarray], width: int) -> Callable:
    """The second pass in a task: the sum of centred outer products, and of the centred vectors themselves."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for b in batches:
            c = centred(_matrix(b.column(0), dims))
            total[:-1] += c.T @ c
            total[-1] += c.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"products": pa.array([total.tobytes()], pa.binary())})

    return run


def _merged(parts: DataFrame, width: int) -> np.ndarray:
    """The tasks' matrices, summed as a tree."""
    rdd = parts.rdd.map(lambda r: np.frombuffer(r[0]).reshape(width + 1, width))
    return rdd.treeAggregate(np.zeros((width + 1, width)), lambda a, b: a + b, lambda a, b: a + b, DEPTH)


class Whitening:
    """What the passes find: count ``n``, exact ``sums``, ``values`` and unit ``vectors`` (a column each) of the components, ``trace``."""

    def __init__(self, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray, trace: float, drift: np.ndarray):
        self.n, self.sums, self.values, self.vectors, self.trace, self.drift = n, sums, values, vectors, trace, drift
        self.projection = vectors / np.sqrt(values)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums).astype(np.float64) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.projection


def fit(vectors: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``vectors`` (one column of ``dims`` numbers), or None if there is no row."""
    spark = vectors.sparkSession
    first = vectors.mapInArrow(_sums_of(dims), "n bigint, sums array<string>")
    n, sums = first.rdd.map(lambda r: (r[0], [int(s) for s in r[1]])).treeAggregate((0, [0] * dims), _added, _added, DEPTH)
    if not n:
        return None
    sums = np.array(sums, dtype=object)
    found = Whitening(n, sums, np.ones(0), np.zeros((dims, 0)), 0.0, np.zeros(dims))
    known = spark.sparkContext.broadcast(found)
    parts = vectors.mapInArrow(_products_of(dims, lambda x: known.value.centred(x), dims), "products binary")
    total = _merged(parts, dims)
    covariance = total[:-1] / n
    values, basis = np.linalg.eigh((covariance + covariance.T) / 2)
    order = [int(k) for k in np.argsort(-values, kind="stable")[:components] if values[k] > EPSILON * dims * max(values.max(), 0.0)]
    signs = [1.0 if basis[np.abs(basis[:, k]).argmax(), k] > 0 else -1.0 for k in order]  # the largest entry is positive
    return Whitening(n, sums, values[order], basis[:, order] * np.array(signs), float(np.trace(covariance)), total[-1] / n)


def _added(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], [x + y for x, y in zip(a[1], b[1], strict=True)]


def identity_error(vectors: DataFrame, dims: int, found: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    width = found.projection.shape[1]
    if not width:
        return 0.0
    known = vectors.sparkSession.sparkContext.broadcast((found, found.drift @ found.projection))
    parts = vectors.mapInArrow(_products_of(dims, lambda x: known.value[0].whitened(x) - known.value[1], width), "products binary")
    return float(np.abs(_merged(parts, width)[:-1] / found.n - np.eye(width)).max())


def whiten(df: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable row of ``df`` and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Left out are rows whose vector is null or empty, holds nulls or non-finite entries or such beyond
    2 ** 56, or is of another length than most (of lengths that are as frequent, the longest counts).
    The covariance is over all other rows, with divisor n; components fall by variance. Those without
    variance have no scale and are left out, so a table of equal vectors has no rows, and neither has
    an empty one. Rows that repeat count and are returned as often as they occur; null ids are
    returned as such. ``deviation`` is exact, a decimal of 38 digits. Other columns may have any names.
    """
    spark, kind = df.sparkSession, df.schema[id_col].dataType
    own = df.select(F.col("`" + id_col.replace("`", "``") + "`").alias("id"), F.col("`" + vec_col.replace("`", "``") + "`").alias("vec"))
    fine = usable(own, "vec")
    schema = T.StructType().add("vec_id", kind).add("component", "integer").add("n", "long").add("deviation", T.DecimalType(38, 0)).add("whitened", "double").add("explained", "double").add("identity_error", "double")
    lengths = fine.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    dims = lengths[0][0]
    fine = fine.filter(F.size("vec") == dims)
    found = fit(fine.select("vec"), dims, components)
    if found is None or not len(found.values):
        return spark.createDataFrame([], schema)
    error = identity_error(fine.select("vec"), dims, found)
    known = spark.sparkContext.broadcast(found)  # dims * (components + 1) numbers
    id_type = to_arrow_type(kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = known.value
        width = len(f.values)
        explained = f.values / f.trace
        for b in batches:
            x = _matrix(b.column("vec"), dims)
            each = pa.array(np.repeat(np.arange(len(x)), width))
            deviation = pa.array([Decimal(s) for s in _squares(_centred(x, f.n, f.sums))], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("id").cast(id_type).take(each), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * width, f.n, dtype=np.int64)),
                    deviation.take(each), pa.array(f.whitened(x).reshape(-1)), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * width, error)),
                ],
                names=schema.names,
            )

    return fine.mapInArrow(run, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors of ``embeddings`` along their 32 widest directions, each scaled to unit variance."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("bigint"))

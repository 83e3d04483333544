"""Whitening of embeddings with MLlib block matrices.

Vectors are taken in whole numbers: entry ``c`` becomes ``x = floor(256 * c)``.
The fit list is each distinct ``x`` once. Its centred rows are dealt into the
blocks of a ``BlockMatrix``, whose transpose times itself is the scatter matrix;
the eigenvectors of that small matrix are found on the driver, and a second
``BlockMatrix`` product projects the centred rows on them.

The product for the scatter splits its inner dimension, so that no task reads all
blocks. Blocks are built once in the task that holds their rows and written to
the shared folder with the ids of their rows. The driver holds the sums of each
dimension, matrices of dimension by dimension, and one number for each task; MLlib
also plans a product there with one pair of numbers for each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.common import tasks_of
from marlstone.session import staged, stack

SCALE = 256
COMPONENTS = 4
#: Entries of one block.
BLOCK = 1 << 17
#: Whole numbers end here, where doubles no longer tell neighbours apart.
LARGEST = 1 << 53


@dataclass(frozen=True)
class Whitening:
    """A fitted transform; ``axes`` has one column for each component of an eigenvalue above zero."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    explained: list[float | None]
    axes: np.ndarray

    @property
    def means(self) -> np.ndarray:
        return np.array([int(s) / self.n for s in self.sums])


def whole_numbers(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id, x`` of rows with a vector of finite entries; shorter vectors are filled up with zeros."""
    rows = df.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & F.forall("v", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))))
    size = rows.agg(F.max(F.size("v"))).first()[0] or 0
    entry = F.transform("v", lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))))
    return rows.select("id", F.concat(entry, F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("v"))).alias("x"))


def _rows_of(x: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = x.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(x), -1)


def _block(size: int, with_ids: bool):
    per = max(1, BLOCK // max(1, size))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def block(table: pa.Table) -> pa.RecordBatch:
            x = _rows_of(table.column("x").combine_chunks())
            columns = [pa.array([task]), pa.array([number]), pa.array([len(x)]), pa.array([x.ravel()], pa.list_(pa.int64()))]
            names = ["task", "number", "rows", "x"]
            if with_ids:
                ids = table.column("id").combine_chunks()
                columns.append(pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids))
                names.append("ids")
            return pa.record_batch(columns, names=names)

        for part in parts:
            held.append(part)
            rows += part.num_rows
            if rows < per:
                continue
            whole, at = pa.Table.from_batches(held), 0
            while rows - at >= per:
                yield block(whole.slice(at, per))
                number, at = number + 1, at + per
            held, rows = whole.slice(at).to_batches(), rows - at
        if rows:
            yield block(pa.Table.from_batches(held))
    return run


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (``x`` and perhaps ``id``) in blocks of bounded size, written once; blocks count from 0 in each task."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("task", "number", "rows")]
                          + [T.StructField("x", T.ArrayType(T.LongType()))])
    if "id" in rows.columns:
        schema = schema.add("ids", T.ArrayType(rows.schema["id"].dataType))
    return staged(rows.mapInArrow(_block(size, "id" in rows.columns), schema))


def numbered(parts: DataFrame, first: int = 0) -> tuple[DataFrame, int]:
    """``parts`` with a number ``b`` for each block, from ``first`` on without gaps, and the number after the last."""
    starts, at = [], first
    for task, n in sorted(tuple(r) for r in parts.groupBy("task").count().collect()):
        starts.append((task, at))
        at += n
    table = parts.sparkSession.createDataFrame(starts, "task long, first long")
    return parts.join(table, "task").withColumn("b", F.col("first") + F.col("number")).drop("task", "number", "first"), at


def _sum_parts(size: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for flat in part.column("x"):
                x = flat.values.to_numpy(zero_copy_only=False).reshape(-1, size)
                high, low = x >> 32, x & 0xFFFFFFFF
                yield pa.record_batch([pa.array(np.arange(size)), pa.array(high.sum(axis=0)), pa.array(low.sum(axis=0))],
                                      names=["at", "high", "low"])
    return run


def sums_of(parts: DataFrame, size: int) -> np.ndarray:
    """The exact sum of every dimension, as Python integers."""
    halves = parts.select("x").mapInArrow(_sum_parts(size), "at long, high long, low long")
    total = halves.groupBy("at").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]).collect()
    out = np.zeros(size, dtype=object)
    for r in total:
        out[r["at"]] = (int(r.high) << 32) + int(r.low)
    return out


def _centred(means: np.ndarray, height: int):
    """Blocks as bytes of doubles, column by column, filled up to ``height`` rows with zeros."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for b, flat in zip(part.column("b").to_pylist(), part.column("x")):
                x = flat.values.to_numpy(zero_copy_only=False).reshape(-1, len(means))
                out = np.zeros((len(means), height))
                out[:, :len(x)] = (x - means).T
                yield pa.record_batch([pa.array([b]), pa.array([out.tobytes()], pa.binary())], names=["b", "values"])
    return run


def _matrix(parts: DataFrame, means: np.ndarray, height: int, count: int) -> BlockMatrix:
    size = len(means)
    rdd = parts.select("b", "x").mapInArrow(_centred(means, height), "b long, values binary").rdd.map(
        lambda r: ((r.b, 0), DenseMatrix(height, size, np.frombuffer(r["values"]))))
    return BlockMatrix(rdd, height, size, count * height, size)


def _times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """A product whose inner dimension is dealt to ``splits`` tasks, a parameter that Python's ``multiply`` lacks."""
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def fit(parts: DataFrame, size: int, n: int, count: int, height: int, components: int = COMPONENTS) -> Whitening:
    """Mean, scatter and leading eigenvectors of the distinct rows in ``parts`` (``b``, ``x``)."""
    sums = sums_of(parts, size)
    means = np.array([int(s) / n for s in sums])
    centred = _matrix(parts, means, height, count).persist(StorageLevel.MEMORY_AND_DISK)
    scatter = _times(centred.transpose(), centred, min(count, tasks_of(parts))).toLocalMatrix().toArray()
    centred.blocks.unpersist()
    covariance = (scatter + scatter.T) / (2 * n)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    trace = float(np.trace(covariance))
    good = int((values > trace * size * np.finfo(float).eps).sum())
    return Whitening(n, sums, values, [float(v) / trace if trace > 0 else None for v in values],
                     axes[:, :good] / np.sqrt(values[:good]))


def project(parts: DataFrame, model: Whitening, count: int, height: int) -> DataFrame:
    """``b, values``: every block of ``parts`` centred and multiplied by the axes, as bytes, column by column; written once."""
    spark = parts.sparkSession
    size, width = model.axes.shape
    axes = DenseMatrix(size, width, model.axes.ravel(order="F"))
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), axes)], 1), size, width, size, width)
    product = _matrix(parts, model.means, height, count).multiply(right)
    found = product.blocks.map(lambda kv: (kv[0][0], bytearray(kv[1].toArray().ravel(order="F").tobytes())))
    return staged(spark.createDataFrame(found, "b long, values binary"))


def _gram(width: int, height: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            total = np.zeros((width, width))
            mean = np.zeros(width)
            for rows, data in zip(part.column("rows").to_pylist(), part.column("values").to_pylist()):
                w = np.frombuffer(data).reshape(width, height)[:, :rows]
                total += w @ w.T
                mean += w.sum(axis=1)
            flat = np.concatenate([total.ravel(), mean])
            yield pa.record_batch([pa.array(np.arange(len(flat))), pa.array(flat)], names=["at", "v"])
    return run


def identity_error(fitted: DataFrame, n: int, width: int, height: int) -> float | None:
    """The largest difference between the covariance of projected blocks (``rows``, ``values``) and the identity."""
    if not width:
        return None
    rows = fitted.mapInArrow(_gram(width, height), "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(width * width + width)
    for r in rows:
        flat[r["at"]] = r.v
    mean = flat[width * width:] / n
    covariance = flat[:width * width].reshape(width, width) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(width)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - sum) ** 2, exact; None beyond 64 bits."""
    furthest = n * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0)
    if furthest ** 2 * max(1, len(sums)) < 1 << 63:
        return ((n * x - sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
    return [v if v < 1 << 63 else None for v in ((n * x.astype(object) - sums) ** 2).sum(axis=1).tolist()]


def _deviation(n: int, sums: np.ndarray):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            values = [deviations(flat.values.to_numpy(zero_copy_only=False).reshape(-1, len(sums)), n, sums) for flat in part.column("x")]
            yield pa.record_batch([part.column("b"), part.column("ids"), pa.array(values, pa.list_(pa.int64()))],
                                  names=["b", "ids", "deviations"])
    return run


def _result(model: Whitening, components: int, height: int, error: float | None, names: list[str]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = model.axes.shape[1]
        for part in parts:
            for i in range(part.num_rows):
                ids = part.column("ids").slice(i, 1).flatten()
                deviation = part.column("deviations").slice(i, 1).flatten()
                data = part.column("values")[i].as_py() if width else None
                w = np.frombuffer(data).reshape(width, height) if width else None
                n = len(ids)
                for c in range(components):
                    whitened = pa.array(w[c, :n]) if c < width else pa.nulls(n, pa.float64())
                    yield pa.record_batch([ids, pa.array(np.full(n, c + 1, np.int32)), pa.array(np.full(n, model.n)), deviation, whitened,
                                           pa.array([model.explained[c]] * n, pa.float64()), pa.array([error] * n, pa.float64())],
                                          names=names)
    return run


def whiten(df: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null or holds a null, NaN or infinite entry are left out;
    other columns are ignored, repeated rows are rows of their own and count once
    in the fit. A vector shorter than the longest counts as zero in the missing
    dimensions. Entries beyond 2**53 / 256 count as that. ``deviation`` is null if
    it needs more than 64 bits. A component without variance has ``whitened``
    null and no part in ``identity_error``; ``explained`` is null if all vectors
    are the same. An empty table gives no rows.
    """
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    types = [df.schema[vec_id].dataType, T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])
    rows = whole_numbers(df, vec_id, vector)
    first = rows.first()
    if first is None or not first.x:
        return df.sparkSession.createDataFrame([], schema)
    size, components = len(first.x), min(components, len(first.x))
    listed = blocks(rows.select("x").distinct(), size)
    every = blocks(rows, size)
    n, tallest = listed.agg(F.sum("rows"), F.max("rows")).first()
    height = max(tallest, every.agg(F.max("rows")).first()[0])
    fitted, count = numbered(listed)
    model = fit(fitted, size, n, count, height, components)
    every, total = numbered(every, count)
    width = model.axes.shape[1]
    numbers = every.mapInArrow(_deviation(n, model.sums), T.StructType([
        T.StructField("b", T.LongType()), every.schema["ids"], T.StructField("deviations", T.ArrayType(T.LongType()))]))
    if width:
        projected = project(stack(fitted.select("b", "x"), every.select("b", "x")), model, total, height)
        error = identity_error(fitted.select("b", "rows").join(projected, "b").select("rows", "values"), n, width, height)
        numbers = numbers.join(projected, "b")
    else:
        error = None
    return numbers.mapInArrow(_result(model, components, height, error, names), schema)

"""Keeping a chunk index up to date with arriving articles.

Every micro-batch writes its chunks to its own folder, so a replay writes the
same folder again. A document that arrives again is replaced as a whole: the
index shows, per document, only the chunks of its newest batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def refresh(articles: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
            order: str | None = None, key: str = "doc_id") -> DataStreamWriter:
    """Chunk and embed arriving documents with ``build``; the newest by ``order`` wins inside a batch."""

    def write(batch: DataFrame, number: int) -> None:
        rest = sorted((c for c in batch.columns if c != key), key=lambda c: c != order)
        newest = F.struct(*rest)
        docs = batch.groupBy(key).agg(F.max(newest).alias("d")).select(key, *[f"d.{c}" for c in rest])
        build(docs).write.mode("overwrite").parquet(f"{path}/chunks/batch={number}")
        docs.select(key).write.mode("overwrite").parquet(f"{path}/docs/batch={number}")

    return (
        articles.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    )


def current_index(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """The chunks of the newest version of every document."""
    newest = spark.read.parquet(f"{path}/docs").groupBy(key).agg(F.max("batch").alias("batch"))
    return spark.read.parquet(f"{path}/chunks").join(newest, [key, "batch"]).drop("batch")

"""Stored tables: embedded corpora, chunk indexes, marts, reports and run logs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.sources.documents import path_exists


def fingerprint(df: DataFrame, *columns: str) -> str:
    """Row count and order-free hash of the given columns."""
    row = df.agg(F.count("*").alias("n"),
                 F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h")).first()
    return f"{row['n']}:{row['h']}"


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_or_build(spark: SparkSession, path: str, source: DataFrame, columns: list[str],
                  build: Callable[[DataFrame], DataFrame], rebuild: bool = False) -> DataFrame:
    """The stored table if it was built from the same source rows, else build and store it.

    The source's fingerprint is in the folder name, so a changed source never
    meets an old table and a failed write is never taken for a finished one.
    """
    target = f"{path}/v{fingerprint(source, *columns).replace(':', '_').replace('-', 'm')}"
    if rebuild or not path_exists(spark, f"{target}/_SUCCESS"):
        save_table(build(source), target)
    return spark.read.parquet(target)


def create_chunk_index(chunks: DataFrame, name: str) -> None:
    """Replace a chunk table (``chunk_id, content, embedding, ...``) in the catalog."""
    chunks.write.mode("overwrite").option("overwriteSchema", True).saveAsTable(name)


def open_chunk_index(spark: SparkSession, name: str) -> tuple[DataFrame, int]:
    """A stored chunk table and its number of chunks."""
    table = spark.read.table(name)
    return table, table.count()


def replace_table(df: DataFrame, name: str) -> None:
    """Create or replace a warehouse table."""
    df.write.mode("overwrite").saveAsTable(name)


def materialise(df: DataFrame, name: str, layer: str) -> DataFrame:
    """Staging models become views, intermediate ones stay plain, marts become tables."""
    if layer == "staging":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if layer == "intermediate":
        return df
    if layer == "marts":
        replace_table(df, name)
        return df.sparkSession.table(name)
    raise ValueError(f"Unknown layer '{layer}'")


def write_json_report(report: DataFrame, path: str) -> None:
    """A one-row report as one JSON file; the folder is created."""
    report.coalesce(1).write.mode("overwrite").json(path)


def append_run(metrics: DataFrame, config: dict[str, object], path: str) -> DataFrame:
    """Append one row with a UTC stamp, the settings and the metrics to the run log."""
    pairs = metrics.agg(F.map_from_entries(F.collect_list(F.struct("metric", "score"))).alias("metrics"))
    row = pairs.select(tx.compact_stamp(F.current_timestamp()).alias("timestamp"),
                       *[F.lit(v).alias(k) for k, v in config.items()], "metrics")
    row.write.mode("append").parquet(path)
    return metrics.sparkSession.read.option("mergeSchema", True).parquet(path)

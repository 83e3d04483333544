"""Session helpers: a local session for tests and bench, and staged tables that
cut lineage through shared storage."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK = 500_000
ROWS_TO_HASH = 100_000
BATCH_BYTES = 4 << 20


def local_session(cpus: int | str = "*", app: str = "marlstone", **conf: str) -> SparkSession:
    """A session on this machine; on a cluster use the session the cluster gives."""
    partitions = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting takes a folder in its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/marlstone-shared"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result has no lineage behind it, survives the loss of executors, and its
    file sizes tell the optimizer whether a later join may broadcast it.
    ``compression`` replaces the session's Parquet codec.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/marlstone-staged/{uuid.uuid4().hex}"
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores when they come from fewer tasks than there are cores.

    For tables of a few files in front of heavy work per row. A table with at
    least as many input splits as cores is left as it is, so a large one is
    never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, *keys: str, rows: int = ROWS_PER_TASK) -> DataFrame:
    """``df``, a table as it is read, dealt out by ``keys`` to tasks of about ``rows`` rows each.

    For a grouping by all of ``keys`` whose groups are about as many as the rows. Splits of files
    and merged partitions are measured in compressed bytes, in which narrow rows
    hardly count, so what such a task holds in memory grows with the table.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(tasks, *keys)


def looked_up(df: DataFrame, rows: int = ROWS_TO_HASH) -> DataFrame:
    """``df``, a staged table in a join with a much larger one: of more than ``rows`` rows, it is looked up by hash.

    Spark would sort both sides then. A smaller table is left to its measured size.
    """
    return df.hint("shuffle_hash") if df.count() > rows else df


def bounded_batches(spark: SparkSession) -> None:
    """Whole texts go to Python workers in batches of ``BATCH_BYTES``; a session that sets a bound of its own keeps it.

    Spark's bound is 10,000 rows or 64 MB, which the executor and the worker each hold, for every task.
    """
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, None) is None:
        spark.conf.set(bound, str(BATCH_BYTES))


def stack(*parts: DataFrame) -> DataFrame:
    """The rows of all parts, columns matched by name.

    Spark 4.1 takes a union of parts that are partitioned alike for partitioned
    in that way, but adaptive execution may have merged the partitions of each
    part differently, and a grouping or join on top then misses rows that belong
    together. So that assumption is switched off for the session; the grouping
    gets its own exchange again.
    """
    parts[0].sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")
    return reduce(lambda a, b: a.unionByName(b), parts)

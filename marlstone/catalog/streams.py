"""Stream jobs run to their end over the tables, as files that have arrived."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marlstone.catalog.base import table
from marlstone.catalog.conversations import ROUTES, STATE_SQL
from marlstone.operators import chunking
from marlstone.operators.embedding import HashingEmbedder
from marlstone.session import shared_folder
from marlstone.streaming import index_refresh, thread_state


def _work(spark) -> str:
    return f"{shared_folder(spark)}/marlstone-streams/{uuid.uuid4().hex}"


def _arriving(spark, folder, df, parts):
    """Write a table as ``parts`` files, read one by one."""
    df.repartition(parts).write.parquet(f"{folder}/in")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def conversation_stream(spark, sf):
    """State per thread after three micro-batches that split the threads."""
    folder = _work(spark)
    messages = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    stream = _arriving(spark, folder, messages, 3)
    thread_state.state_writer(stream, f"{folder}/states", f"{folder}/cp", ROUTES).start().awaitTermination()
    return thread_state.latest_states(spark.read.parquet(f"{folder}/states"))


def conversation_history(spark, sf):
    folder = _work(spark)
    messages = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    stream = _arriving(spark, folder, messages, 3)
    thread_state.history_writer(stream, f"{folder}/history", f"{folder}/cp").start().awaitTermination()
    return spark.read.parquet(f"{folder}/history")


def incremental_index(spark, sf):
    """The index after documents arrived in two halves and then, changed, a second time.

    A half is as many files as its rows come in and one micro-batch, so no task holds more than its share.
    """
    folder = _work(spark)
    docs = table(spark, sf, "documents").select("doc_id", "text", F.lit(1).alias("version"))
    again = docs.filter(F.col("text").contains("License")).select(
        "doc_id", F.concat(F.lit("again "), "text").alias("text"), F.lit(2).alias("version"))
    embedder = HashingEmbedder(64)
    build = lambda d: embedder.encode(chunking.chunk_fixed(d), "content")
    half = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(2)), F.lit(0))
    for part in (docs.filter(half == 0), docs.filter(half == 1), again):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(docs.schema).parquet(f"{folder}/in")
        index_refresh.refresh(stream, build, f"{folder}/index", f"{folder}/cp", order="version").start().awaitTermination()
    index = index_refresh.current_index(spark, f"{folder}/index")
    return index.select("doc_id", "chunk_pos", "version", "content", F.size("embedding").alias("dim"))


QUERIES = {f.__name__: f for f in (conversation_stream, conversation_history, incremental_index)}

SQL = {
    "conversation_stream": f"WITH {STATE_SQL} SELECT * FROM state",
    "conversation_history": "SELECT conv_id, turn, role, text FROM conversations",
    "incremental_index": """
WITH d AS (SELECT doc_id, CASE WHEN contains(text, 'License') THEN 'again ' || text ELSE text END AS text,
    CASE WHEN contains(text, 'License') THEN 2 ELSE 1 END AS version FROM documents),
c AS (SELECT *, unnest(range(0, length(text), 450)) AS s FROM d)
SELECT doc_id, CAST(s // 450 AS INTEGER) AS chunk_pos, version, substring(text, s + 1, 500) AS content,
  CAST(64 AS INTEGER) AS dim
FROM c WHERE regexp_matches(substring(text, s + 1, 500), '\\S')""",
}

"""Conversation state of a message stream.

The state of a thread is the same set of aggregates as in batch; Spark keeps
them in its state store, combines each micro-batch in the tasks before the
shuffle, and restores them after a failure. The history itself is appended to a
table and is not held in state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from marlstone.operators.conversations import Routes, conversation_state


def state_stream(messages: DataFrame, routes: Routes = Routes()) -> DataFrame:
    """Streaming state per ``conv_id``; write it in ``update`` or ``complete`` mode."""
    return conversation_state(messages, routes)


def history_writer(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append the messages to a table, each exactly once."""
    return (
        messages.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True)
    )


def state_writer(messages: DataFrame, path: str, checkpoint: str, routes: Routes = Routes()) -> DataStreamWriter:
    """Write the changed states of every micro-batch to ``<path>/batch=<n>``; a replay overwrites its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        state_stream(messages, routes).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True)
    )


def latest_states(changes: DataFrame) -> DataFrame:
    """The newest written state of every thread."""
    from pyspark.sql import functions as F

    rest = [c for c in changes.columns if c not in ("conv_id", "batch")]
    return changes.groupBy("conv_id").agg(F.max_by(F.struct(*rest), "batch").alias("s")).select("conv_id", "s.*")

"""What the operators share: tables, words, keys of texts, ordered runs.

``WORD`` is the word of every operator here: a longest run of characters that
are neither blank nor one of the five ASCII line and tab characters.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.session import staged

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = "\t\n\x0b\x0c\r "


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    blank = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.array_remove(F.split(blank, " "), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes of a text; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("_h"), F.xxhash64(F.lit(1), whole).alias("_g")]


def draw(*columns: Column) -> Column:
    """A number in [0, 1) fixed by the given columns, so that reruns agree."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def fold(doc_id: Column, folds: int) -> Column:
    """Unsigned crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def tasks_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def byte_words(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased. ``bytes.split`` splits at exactly the six blanks of ``WORD``."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def batches(rows: Iterable[Sequence], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded length."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows, schema):
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def in_runs(df: DataFrame, group: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``df`` written once in the order of ``group`` then ``order``, cut into runs.

    Adds ``_run``: a range of the whole order, so a large group spreads over many
    runs, and runs ascend. Only rows equal in all keys are sure to share a run.
    Work over a group is then done in each run, and what earlier runs hold is
    brought in by a table of one row per group and run.
    """
    ranged = df.repartitionByRange(tasks_of(df), *group, *order)
    return staged(ranged.withColumn("_run", F.spark_partition_id()))


def before(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], sums: dict[str, str | Column]) -> DataFrame:
    """For runs from ``in_runs``: the sum of each expression over all earlier rows of the group.

    ``sums`` maps a new column to the expression that is added up. Rows equal in
    all of ``order`` get an arbitrary order among themselves.
    """
    added = {f"_add_{k}": F.expr(v) if isinstance(v, str) else v for k, v in sums.items()}
    df = df.withColumns(added)
    by_run = df.groupBy(*group, "_run").agg(*[F.sum(f"_add_{k}").alias(f"_sum_{k}") for k in sums])
    earlier = Window.partitionBy(*group).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    by_run = by_run.select(*group, "_run", *[F.coalesce(F.sum(f"_sum_{k}").over(earlier), F.lit(0)).alias(f"_from_{k}")
                                             for k in sums])
    inside = Window.partitionBy("_run", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({f"_in_{k}": F.coalesce(F.sum(f"_add_{k}").over(inside), F.lit(0)) for k in sums})
    df = join_safe(df, by_run, ["_run", *group])
    df = df.withColumns({k: F.col(f"_in_{k}") + F.col(f"_from_{k}") for k in sums})
    return df.drop(*[p + k for k in sums for p in ("_add_", "_in_", "_from_")])


def join_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null meets null; the keys of ``right`` are dropped."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[k].eqNullSafe(right[f"_right_{k}"]) for k in keys]
    joined = left.join(right, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def hashed(pieces: Iterable[bytes], seed: int = 42) -> np.ndarray:
    """XXH64 of every piece."""
    from functools import partial

    import xxhash

    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), pieces), dtype=np.uint64)


def shingles(tokens: list[bytes], size: int) -> Iterable[bytes]:
    """Windows of ``size`` words joined by a blank; a shorter text is one window, an empty one none."""
    if len(tokens) < size:
        return [b" ".join(tokens)] if tokens else []
    return map(b" ".join, zip(*[tokens[i:] for i in range(size)]))

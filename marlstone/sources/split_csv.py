"""CSV with line breaks inside quotes, one file read by many tasks.

A file is read line by line in splits. Whether a line begins a record depends on
whether the number of quotes before it is even, so one pass counts, for each
split, its quotes and the records that would begin in it in either case. The
prefix sums of these few numbers tell every split how it begins, and a second
pass cuts records. A record that runs over the end of splits is put together from
one piece of each.

Quotes follow RFC 4180: a value with a quote, a separator or a line break is quoted,
and a quote in it is doubled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.session import stack, staged

_SPLIT = "file string, block long, lines long, odd int, even_starts long, odd_starts long"
_PIECE = "file string, block long, place long, kind string, value string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _stretches(part: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """Rows of a batch by split; a task may read several."""
    blocks, files = part.column(1).to_numpy(zero_copy_only=False), part.column(0).dictionary_encode()
    codes = files.indices.to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (codes[1:] != codes[:-1])) + 1
    for a, b in zip([0, *cuts], [*cuts, len(blocks)]):
        if b > a:
            yield files.dictionary[codes[a]].as_py(), int(blocks[a]), part.column(2).slice(a, b - a)


def _quotes(values: pa.Array) -> np.ndarray:
    return pc.count_substring(values, '"').to_numpy(zero_copy_only=False)


def _blank(values: pa.Array) -> np.ndarray:
    return pc.is_in(values, value_set=pa.array(["", "\r"])).to_numpy(zero_copy_only=False)


def _odd_before(quotes: np.ndarray) -> np.ndarray:
    """For each line, 1 if an odd number of quotes of the split stands before it."""
    return (np.cumsum(quotes) - quotes) & 1


def _count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int], list[int]] = {}
    for part in parts:
        for file, block, values in _stretches(part):
            quotes = _quotes(values)
            total = held.setdefault((file, block), [0, 0, 0, 0])
            odd = _odd_before(quotes) ^ total[1]
            total[0] += len(quotes)
            total[1] ^= int(quotes.sum()) & 1
            said = ~_blank(values)
            total[2] += int(((odd == 0) & said).sum())
            total[3] += int(((odd == 1) & said).sum())
    rows = [(*k, *v) for k, v in held.items()]
    columns = list(zip(*rows)) or [[]] * 6
    yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                          names=["file", "block", "lines", "odd", "even_starts", "odd_starts"])


def _cut(begins_odd: dict[tuple[str, int], int]):
    """Whole records (``kind`` record), the lines before the first record (head) and the open last record (tail) of a split."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def end(rows):
            if now is not None and state["open"] is not None:
                kind = "tail" if state["odd"] and state["place"] >= 0 else "record" if state["place"] >= 0 else "head"
                rows.append((*now, max(state["place"], 0), kind, "\n".join(state["open"])))

        def batch(rows):
            columns = list(zip(*rows)) or [[]] * 5
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                   names=["file", "block", "place", "kind", "value"])

        for part in parts:
            rows = []
            for file, block, values in _stretches(part):
                if now != (file, block):
                    end(rows)
                    now, state = (file, block), {"odd": begins_odd[file, block], "place": -1, "open": None}
                quotes = _quotes(values)
                inside = _odd_before(quotes) ^ state["odd"]
                state["odd"] ^= int(quotes.sum()) & 1
                for value, odd, blank in zip(values.to_pylist(), inside.tolist(), _blank(values).tolist()):
                    if odd:  # goes on with the record, or with that of an earlier split
                        state["open"] = state["open"] or []
                        state["open"].append(value)
                        continue
                    if state["open"] is not None:
                        rows.append((*now, max(state["place"], 0), "record" if state["place"] >= 0 else "head", "\n".join(state["open"])))
                        state["open"] = None
                    if not blank:
                        state["place"], state["open"] = state["place"] + 1, [value]
            yield batch(rows)
        rows = []
        end(rows)
        yield batch(rows)
    return run


def _prefixes(splits: DataFrame) -> DataFrame:
    """Of every split: whether it begins inside quotes, and the number of records that begin before it. One row for each
    split of a file."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = splits.withColumn("begins_odd", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    begins = begins.withColumn("starts", F.when(F.col("begins_odd") == 0, F.col("even_starts")).otherwise(F.col("odd_starts")))
    return begins.select("file", "block", "begins_odd", F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("before"))


def header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names of a CSV file; reads no data rows."""
    return spark.read.option("header", True).csv(path).columns


def csv_records(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """``_file, _row, _record``: every data row of CSV files with one header, ``_row`` numbered from 0 in its file.

    ``_record`` is a struct by ``schema``; without one, every column of the header
    is text. Blank lines are no rows, an unclosed quote reaches to the end of its file.
    """
    if schema is None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header(spark, path)])
    lines = _lines(spark, path)
    splits = staged(_prefixes(lines.mapInArrow(_count, _SPLIT)))
    begins_odd = {(r.file, r.block): int(r.begins_odd) for r in splits.select("file", "block", "begins_odd").collect()}
    placed = lines.mapInArrow(_cut(begins_odd), _PIECE).join(splits, ["file", "block"])
    number = F.when(F.col("kind") == "head", F.col("before") - 1).otherwise(F.col("before") + F.col("place"))
    pieces = placed.select("file", number.alias("number"), "block", "kind", "value")
    whole = pieces.filter(F.col("kind") == "record").select("file", "number", "value")
    ordered = F.sort_array(F.collect_list(F.struct("block", "value")))  # one piece of a record from each split
    joined = pieces.filter(F.col("kind") != "record").groupBy("file", "number").agg(
        F.array_join(F.transform(ordered, lambda p: p["value"]), "\n").alias("value"))
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    record = F.from_csv(F.regexp_replace("value", r"\r$", ""), ddl, {"escape": '"'})
    return stack(whole, joined).filter(F.col("number") > 0).select(
        F.col("file").alias("_file"), (F.col("number") - 1).alias("_row"), record.alias("_record"))

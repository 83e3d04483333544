"""A stored BM25 index whose search leaves out blocks of documents.

Documents are put in an order in which similar ones are near, and cut into blocks
of equal size. The index has one row for each term and block: the postings of the
block and the largest share of a score that any of them can give. The sum of
these over the terms of a query bounds the score of every document of the block.

A search scores the blocks of the highest bounds first. The ``k``-th best score
found so is a threshold: blocks whose bound is below it hold no hit and their
postings are never looked at. The result is that of the full scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marlstone.operators.lexical import B, K1, _bounded_terms, _list_lengths, _terms, _TermMatrix, query_terms
from marlstone.operators.ranking import top_k
from marlstone.operators.scan import NO_SCORE, SCORE_CELLS, TopRows, as_ids, hit_schema, parts_of
from marlstone.session import stack, staged

BLOCK_BITS = 4
FIRST_BLOCKS = 4
#: Scores are compared at 9 digits; a bound is taken a little higher than it is.
SLACK = 1e-6


class BlockIndex(NamedTuple):
    """``blocks(term, block, n, top, postings)`` and one row ``stats(n, avgdl, k1, b)``."""

    blocks: DataFrame
    stats: DataFrame

    def save(self, path: str, files: int = 64) -> None:
        """Write both tables; rows are clustered by term in each file so that filters on terms skip row groups.

        A part of the corpus becomes a file, so that postings are not moved; ``files`` no longer bounds their number.
        """
        self.blocks.sortWithinPartitions("term", "block").write.mode("overwrite").parquet(f"{path}/blocks")
        self.stats.write.mode("overwrite").parquet(f"{path}/stats")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BlockIndex":
        return BlockIndex(spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/stats"))


def _share(tf: Column, dl: Column, avgdl: Column, k1: float, b: float) -> Column:
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))


def build(corpus: DataFrame, id_col: str = "chunk_id", text: str = "content", near: tuple[str, ...] = (), k1: float = K1,
          b: float = B, block_bits: int = BLOCK_BITS) -> BlockIndex:
    """Index ``corpus`` in blocks of ``2 ** block_bits`` documents.

    ``near`` names columns that are alike in similar documents, such as the
    language; within them documents are ordered by length. A null text counts as a
    document of length 0.
    """
    cut = corpus.select(*[F.col(c).alias(f"_near{i}") for i, c in enumerate(near)], F.col(id_col).alias("chunk_id"),
                        _terms(text).alias("toks")).withColumn("dl", F.size("toks"))
    unique = cut.groupBy("chunk_id").agg(F.count("*").alias("n")).filter("n > 1 or chunk_id is null").isEmpty()
    stats = staged(cut.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl")).select(
        "n", "avgdl", F.lit(float(k1)).alias("k1"), F.lit(float(b)).alias("b"), F.lit(unique).alias("unique")))
    order = [*[f"_near{i}" for i in range(len(near))], "dl", "chunk_id"]
    placed = cut.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.shiftright(F.monotonically_increasing_id(), block_bits).alias("block"), "chunk_id", "toks")
    posting = T.StructType([placed.schema["chunk_id"], T.StructField("dl", T.IntegerType()), T.StructField("tf", T.LongType())])
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("block", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("top", T.DoubleType()), T.StructField("postings", T.ArrayType(posting))])
    return BlockIndex(placed.mapInArrow(_indexed(to_arrow_schema(schema), stats.first()["avgdl"] or 1.0, k1, b), schema), stats)


def _whole_blocks(parts: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Batches that hold whole blocks, of rows whose column ``at``, the block, ascends."""
    held = None
    for part in parts:
        for piece in parts_of(part, part.num_rows):
            held = piece if held is None else pa.concat_batches([held, piece])
            blocks = held.column(at).to_numpy()
            whole = int(np.searchsorted(blocks, blocks[-1]))
            if whole:
                yield held.slice(0, whole)
                held = held.slice(whole)
    if held is not None and held.num_rows:
        yield held


def _indexed(arrow: pa.Schema, avgdl: float, k1: float, b: float):
    """The rows of the index, counted in the task that holds the documents; rows of one block, id and length are one document."""
    def index(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, size = batch.column(1), _list_lengths(batch.column(2))
        blocks, at = np.unique(batch.column(0).to_numpy(), return_inverse=True)
        code = ids.dictionary_encode("encode").indices.to_numpy()
        _, first, doc = np.unique((at * (code.max() + 1) + code) * (size.max() + 1) + size, return_index=True, return_inverse=True)
        coded = batch.column(2).flatten().dictionary_encode()
        entry, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * len(first) + np.repeat(doc, size), return_counts=True)
        term, doc = entry // len(first), entry % len(first)
        dl, block = size[first][doc], at[first][doc]
        share = tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))
        start = np.flatnonzero(np.diff(term * len(blocks) + block, prepend=-1))
        ends = np.append(start, len(entry))
        postings = pa.StructArray.from_arrays(
            [ids.take(pa.array(first[doc])), pa.array(dl, pa.int32()), pa.array(tf, pa.int64())], fields=list(arrow.field("postings").type.value_type))
        return pa.RecordBatch.from_arrays(
            [coded.dictionary.take(pa.array(term[start])), pa.array(blocks[block[start]]), pa.array(np.diff(ends), pa.int64()),
             pa.array(np.maximum.reduceat(share, start) if len(start) else share),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), postings)], names=arrow.names)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_blocks(parts, 0):
            yield index(batch)
    return run


class Search:
    """A batch of queries against an index; ``hits`` is the result, ``postings_read`` what it cost."""

    def __init__(self, index: BlockIndex, queries: DataFrame, k: int = 20, text: str = "text", first_blocks: int = FIRST_BLOCKS):
        self.blocks, self.stats = index.blocks, index.stats.first()
        rows = _bounded_terms(queries, text)
        if rows and "unique" in index.stats.columns and self.stats["unique"] and not any(r[0] is None for r in rows):
            self._in_tasks(rows, queries.select("query_id").schema["query_id"], k, first_blocks)
        else:
            self._by_joins(queries, k, text, first_blocks)

    def _in_tasks(self, rows: list[tuple], query: T.StructField, k: int, first_blocks: int) -> None:
        """A bounded batch: every task bounds and scores whole blocks; no pair of a query and a block or document is shuffled."""
        spark, n = self.blocks.sparkSession, self.stats["n"]
        words = spark.createDataFrame([(t,) for t in {r[1] for r in rows}], "term string")
        self.heads = self.blocks.select("term", "block", "n", "top").join(words, "term", "left_semi")
        df = {r["term"]: r["df"] for r in self.heads.groupBy("term").agg(F.sum("n").alias("df")).collect()}
        rows = [r for r in rows if r[1] in df]
        values = [float(r[2] * np.log((n - df[r[1]] + 0.5) / (df[r[1]] + 0.5) + 1)) for r in rows]
        weight = T.StructType([query, T.StructField("term", T.StringType()), T.StructField("w", T.DoubleType())])
        self.weights = spark.createDataFrame([(r[0], r[1], w) for r, w in zip(rows, values)], weight)
        id_type = self.blocks.schema["postings"].dataType.elementType["chunk_id"].dataType
        if not rows:
            self.hits = spark.createDataFrame([], hit_schema(query.dataType, "chunk_id", id_type)).withColumn("rank", F.lit(0))
            self.pairs = spark.createDataFrame([], T.StructType([query, T.StructField("block", T.LongType())]))
            return
        matrix = _TermMatrix(rows, values)
        places = spark.createDataFrame(list(zip(matrix.terms, range(len(matrix.terms)))), "term string, no int")
        known = self.blocks.join(places, "term")
        whole = lambda *c: known.select("block", "no", "top", *c).repartition("block").sortWithinPartitions("block")
        ids, step = as_ids(matrix.query_ids), max(1, SCORE_CELLS // len(matrix.query_ids))

        def bounds(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            blocks, at = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            term = batch.column(1).to_numpy().astype(np.int64)
            return blocks, at, matrix.add_up(at, term, batch.column(2).to_numpy(), len(blocks))

        found = hit_schema(query.dataType, "block", T.LongType())
        first_arrow = to_arrow_schema(found)

        def best_blocks(parts):
            best = TopRows(ids, first_blocks)
            for batch in _whole_blocks(parts, 0):
                blocks, _, bound = bounds(batch)
                best.offer(blocks, bound)
            yield from best.table(first_arrow).to_batches()

        first = staged(top_k(whole().mapInArrow(best_blocks, found), first_blocks, F.col("score").desc(), F.col("block").asc()).select(
            "query_id", "block"))
        best = top_k(self._scores(first), k, F.col("score").desc(), F.col("chunk_id").asc())
        least = {r["query_id"]: r["score"] for r in best.filter(F.col("rank") == k).collect()}
        floor = np.array([least.get(q, -np.inf) for q in matrix.query_ids]) - SLACK
        k1, b, avgdl = self.stats["k1"], self.stats["b"], self.stats["avgdl"]
        schema = hit_schema(query.dataType, "chunk_id", id_type)
        arrow = to_arrow_schema(schema)

        def scored(parts):
            top = TopRows(ids, k)
            for batch in _whole_blocks(parts, 0):
                _, at, bound = bounds(batch)
                live = (bound >= floor[:, None]) & (bound > NO_SCORE)
                lists = batch.column(3)
                flat, size = lists.flatten(), _list_lengths(lists)
                block, term = np.repeat(at, size), np.repeat(batch.column(1).to_numpy().astype(np.int64), size)
                coded = flat.field(0).dictionary_encode("encode")
                doc, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False)
                tf, dl = flat.field(2).to_numpy(), flat.field(1).to_numpy()
                factor = tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))
                home = np.zeros(len(names), dtype=np.int64)
                home[doc] = block
                order = np.argsort(doc, kind="stable")
                doc, term, factor = doc[order], term[order], factor[order]
                for low in range(0, len(names), step):
                    high = min(low + step, len(names))
                    part = slice(*np.searchsorted(doc, [low, high]))
                    top.offer(as_ids(names[low:high]), matrix.add_up(
                        doc[part] - low, term[part], factor[part], high - low, live[:, home[low:high]]))
            yield from top.table(arrow).to_batches()

        self.hits = top_k(whole("postings").mapInArrow(scored, schema), k, F.col("score").desc(), F.col("chunk_id").asc())
        limits = spark.createDataFrame([(q, float(x)) for q, x in zip(matrix.query_ids, floor)], T.StructType([
            query, T.StructField("least", T.DoubleType())]))
        every = self.weights.join(self.heads, "term").groupBy("query_id", "block").agg(F.sum(F.col("w") * F.col("top")).alias("bound"))
        others = every.join(limits, "query_id").filter(F.col("bound") >= F.col("least")).select("query_id", "block")
        self.pairs = stack(first, others).distinct()

    def _by_joins(self, queries: DataFrame, k: int, text: str, first_blocks: int) -> None:
        """Any number of queries, and documents whose ids are not unique: the same steps as joins."""
        asked = query_terms(queries, text)
        heads = self.blocks.select("term", "block", "n", "top").join(asked.select("term").distinct(), "term", "left_semi")
        self.heads = staged(heads)
        total = F.lit(self.stats["n"])
        frequency = self.heads.groupBy("term").agg(F.sum("n").alias("df"))
        idf = F.log((total - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
        self.weights = staged(asked.join(frequency, "term").select("query_id", "term", (F.col("qf") * idf).alias("w")))
        bounds = staged(self.weights.join(self.heads, "term").groupBy("query_id", "block").agg(F.sum(F.col("w") * F.col("top")).alias("bound")))
        first = staged(top_k(bounds, first_blocks, F.col("bound").desc(), F.col("block").asc()).select("query_id", "block"))
        some = staged(self._scores(first))
        best = top_k(some, k, F.col("score").desc(), F.col("chunk_id").asc())
        threshold = best.filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
        others = bounds.join(first, ["query_id", "block"], "left_anti").join(threshold, "query_id", "left")
        others = staged(others.filter(F.col("least").isNull() | (F.col("bound") >= F.col("least") - SLACK)).select("query_id", "block"))
        self.pairs = stack(first, others)
        self.hits = top_k(stack(some, self._scores(others)), k, F.col("score").desc(), F.col("chunk_id").asc())

    def _scores(self, pairs: DataFrame) -> DataFrame:
        wanted = pairs.join(self.weights, "query_id")
        posting = wanted.join(self.blocks.select("term", "block", "postings"), ["term", "block"]).select(
            "query_id", "w", F.explode("postings").alias("p"))
        share = _share(F.col("p.tf"), F.col("p.dl"), F.lit(self.stats["avgdl"]), self.stats["k1"], self.stats["b"])
        return posting.groupBy("query_id", F.col("p.chunk_id").alias("chunk_id")).agg(F.round(F.sum(F.col("w") * share), 9).alias("score"))

    def postings_read(self) -> tuple[int, int]:
        """Postings that were scored, added up over the queries, and those that a search without bounds would score."""
        every = self.weights.select("query_id", "term").join(self.heads.select("term", "block", "n"), "term")
        read = every.join(self.pairs, ["query_id", "block"], "left_semi").agg(F.sum("n")).first()[0]
        return read or 0, every.agg(F.sum("n")).first()[0] or 0


def search(index: BlockIndex, queries: DataFrame, k: int = 20, text: str = "text", first_blocks: int = FIRST_BLOCKS) -> DataFrame:
    """``query_id, chunk_id, score, rank``: the ``k`` best documents of each query, ties to the smaller id."""
    return Search(index, queries, k, text, first_blocks).hits

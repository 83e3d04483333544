"""Exact nearest neighbours by dot product or cosine.

A task multiplies its Arrow batches with the query vectors and keeps ``k`` rows per query. Scores are rounded to 9 digits before
ranking: equal vectors must tie although the last bits of a matrix product depend on the place inside the batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marlstone.functions import text as tx
from marlstone.functions import vector as vx
from marlstone.operators.embedding import Embedder
from marlstone.operators.ranking import top_k
from marlstone.operators.scan import NO_SCORE, as_ids, hit_schema
from marlstone.session import stack

# Most query vectors that are sent to every task; larger query tables are joined.
QUERY_BLOCK = 4096
# When both sides are large: corpus rows per tile, and query vectors per block that meets it. Every row is sent to each
# block and every query to each tile, so these are as large as a task holds with ease (100 MB at 64 places).
TILE_ROWS, TILE_QUERIES = 200_000, 32_768
# Smaller tiles than that are cut for the sake of idle cores, but none below this size.
LEAST_ROWS = 20_000
# Corpus rows made ready at one time inside a task, and the rows and queries of one matrix product (2 MB of scores).
ROWS_READY, ROWS_AT_ONCE, QUERIES_AT_ONCE = 8192, 256, 1024
DIGITS = 9


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lists) == 0:
        return np.zeros((0, 0))
    if len(flat) % len(lists):
        raise ValueError("vectors of different length")
    return flat.reshape(len(lists), -1)


def _unit(matrix: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    size[size == 0] = 1.0
    return matrix / size[:, None]


def nearest(corpus: DataFrame, queries: DataFrame, k: int = 5, *, id_col: str = "chunk_id",
            vector: str = "embedding", query_vector: str = "embedding", metric: str = "dot",
            skip_self: bool = False) -> DataFrame:
    """``(query_id, <id_col>, score, rank)``: the ``k`` best corpus rows of every query.

    ``skip_self`` leaves out the corpus row with the query's own id. Rows without
    a vector are ignored. Filter ``corpus`` first to search a part of it.
    """
    if metric not in ("dot", "cosine"):
        raise ValueError("metric must be 'dot' or 'cosine'")
    rows = corpus.select(F.col(id_col), F.col(vector).alias("_v"))
    asked = queries.select("query_id", F.col(query_vector).alias("_q"))
    schema = hit_schema(asked.schema["query_id"].dataType, id_col, rows.schema[id_col].dataType)
    block = asked.limit(QUERY_BLOCK + 1).collect()
    if len(block) > QUERY_BLOCK:
        best = _tiled_search(rows, asked, schema, k, metric == "cosine", skip_self)
        return top_k(best, k, F.col("score").desc(), F.col(id_col).asc())
    block = [r for r in block if r["_q"] is not None]
    query_ids, vectors = as_ids([r["query_id"] for r in block]), np.array([r["_q"] for r in block], dtype=np.float64)
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = NearestRows(query_ids, vectors, k, metric == "cosine", skip_self)
        for batch in batches:
            best.offer(as_ids(batch.column(0).to_numpy(zero_copy_only=False)), batch.column(1))
        yield from best.table(arrow).to_batches()

    return top_k(rows.mapInArrow(scan, schema), k, F.col("score").desc(), F.col(id_col).asc())


def _just_below(scores: np.ndarray) -> np.ndarray:
    """Bounds that no unrounded score stays under if it is rounded to one of ``scores`` or more."""
    return np.where(np.isinf(scores), scores, scores - 10.0 ** -DIGITS - 1e-15 * np.abs(scores))


class NearestRows:
    """The best ``k`` corpus rows per query vector seen so far; ties go to the smaller id.

    All queries are held against a block of rows at once, and only scores that may belong to the
    best are looked at again, rounded and sorted.
    """

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, cosine: bool, skip_self: bool = False):
        self.query_ids, self.k, self.cosine, self.skip_self = query_ids, k, cosine, skip_self
        self.queries = _unit(queries) if cosine and len(queries) else queries
        self.floor = np.full(len(query_ids), np.finfo(np.float64).min)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending = 0
        self.order = np.argsort(query_ids, kind="stable") if skip_self else None

    def offer(self, ids: np.ndarray, vectors: pa.Array) -> None:
        if not len(self.queries):
            return
        for at in range(0, len(ids), ROWS_READY):
            some, names = vectors.slice(at, ROWS_READY), ids[at:at + ROWS_READY]
            names, matrix = names[some.is_valid().to_numpy(zero_copy_only=False)], _matrix(some.drop_null())
            matrix = _unit(matrix) if self.cosine and len(matrix) else matrix
            for low in range(0, len(names), ROWS_AT_ONCE):
                self._block(names[low:low + ROWS_AT_ONCE], matrix[low:low + ROWS_AT_ONCE])

    def _block(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        own = self._own(ids) if self.skip_self else None
        for at in range(0, len(self.queries), QUERIES_AT_ONCE):
            scores = self.queries[at:at + QUERIES_AT_ONCE] @ matrix.T
            if own is not None:
                here = (own[0] >= at) & (own[0] < at + len(scores))
                scores[own[0][here] - at, own[1][here]] = NO_SCORE
            floor = self.floor[at:at + QUERIES_AT_ONCE]
            near = np.nonzero(~(scores.max(axis=1) < floor))[0]  # a score that is no number is looked at below
            scores, floor = scores[near], floor[near]
            few = scores >= floor[:, None]
            if np.count_nonzero(few) > 4 * self.k * len(near) and scores.shape[1] > self.k:
                line = np.where(np.isnan(scores), NO_SCORE, scores)
                floor = np.maximum(floor, _just_below(np.partition(line, -self.k, axis=1)[:, -self.k]))
                few = scores >= floor[:, None]
            query, row = np.nonzero(few)
            if len(query):
                self.found.append((near[query] + at, ids[row], np.round(scores[query, row], DIGITS)))
                self.pending += len(query)
        if self.pending > self.k * len(self.queries):
            self._merge()

    def _own(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries and rows of the same id."""
        known = self.query_ids[self.order]
        low, high = np.searchsorted(known, ids, "left"), np.searchsorted(known, ids, "right")
        row = np.repeat(np.arange(len(ids)), high - low)
        query = self.order[np.arange(len(row)) - np.repeat(np.cumsum(high - low) - high, high - low)]
        same = self.query_ids[query] == ids[row]
        return query[same], row[same]

    def _merge(self) -> None:
        if not self.found:
            return
        query, ids, scores = (np.concatenate(c) for c in zip(*self.found))
        order = np.lexsort((ids, -scores, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = order[place < self.k]
        last = place == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], _just_below(scores[order[last]]))
        self.found, self.pending = [(query[place < self.k], ids[kept], scores[kept])], 0

    def table(self, arrow: pa.Schema) -> pa.Table:
        self._merge()
        if not self.found:
            return arrow.empty_table()
        query, ids, scores = self.found[0]
        columns = (self.query_ids[query], ids, scores)
        return pa.table([pa.array(c).cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _tiled_search(rows: DataFrame, asked: DataFrame, schema: T.StructType, k: int, cosine: bool,
                  skip_self: bool) -> DataFrame:
    """Both sides large: tiles of the corpus meet blocks of the queries, ``k`` rows per query leave each meeting."""
    id_col = schema.names[1]
    n = rows.count()
    blocks = max(1, -(-asked.count() // TILE_QUERIES))
    wanted = -(-2 * rows.sparkSession.sparkContext.defaultParallelism // blocks)
    tiles = max(1, -(-n // TILE_ROWS), min(-(-n // min(LEAST_ROWS, TILE_ROWS)), wanted))
    place = ["_tile", "_block"]
    left = rows.withColumn("_tile", F.pmod(F.xxhash64(id_col), F.lit(tiles))).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    right = asked.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).withColumn(
        "_tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    arrow = to_arrow_schema(schema)

    def meet(corpus_part: pa.Table, query_part: pa.Table) -> pa.Table:
        if not corpus_part.num_rows or not query_part.num_rows:
            return arrow.empty_table()
        query_part = query_part.filter(query_part["_q"].is_valid())
        best = NearestRows(as_ids(query_part["query_id"].to_numpy()), _matrix(query_part["_q"].combine_chunks()), k, cosine, skip_self)
        best.offer(as_ids(corpus_part[id_col].to_numpy()), corpus_part["_v"].combine_chunks())
        return best.table(arrow)

    return left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(meet, schema)


def filtered(corpus: DataFrame, category: str | None = None, min_year: int | None = None,
             category_col: str = "category", year_col: str = "year") -> DataFrame:
    """Equality and lower-bound filters; an empty or zero value means no filter."""
    if category:
        corpus = corpus.filter(F.col(category_col) == category)
    if min_year:
        corpus = corpus.filter(F.col(year_col) >= min_year)
    return corpus


def check_category(corpus: DataFrame, category: str, category_col: str = "category") -> None:
    """Raise with the valid values when no row has ``category``."""
    if corpus.filter(F.col(category_col) == category).isEmpty():
        valid = [r[0] for r in corpus.select(category_col).distinct().orderBy(category_col).limit(100).collect()]
        raise ValueError(f"Unknown category '{category}'. Valid: {valid}")


def semantic_search(corpus: DataFrame, queries: DataFrame, top: int = 5, category: str | None = None,
                    min_year: int | None = None, *, id_col: str = "id", title: str = "title",
                    abstract: str = "abstract", metric: str = "dot") -> DataFrame:
    """Checked filters, exact top-k, pool size, 120-character snippet, score to 4 digits."""
    if category:
        check_category(corpus, category)
    pool = filtered(corpus, category, min_year)
    hits = nearest(pool, queries, top, id_col=id_col, metric=metric)
    shown = pool.select(id_col, title, tx.snippet(abstract).alias("snippet"))
    return hits.join(shown, id_col).select(
        "query_id", "rank", id_col, title, "snippet",
        F.bround("score", 4).alias("score"),
        pool.agg(F.count("*")).scalar().alias("filter_pool"))


def vector_search(chunks: DataFrame, queries: DataFrame, embedder: Embedder, k: int = 20, *,
                  query_text: str = "text", prefix: str = "", id_col: str = "chunk_id") -> DataFrame:
    """Top-k over an embedded chunk table; ``prefix`` goes in front of the query text only."""
    asked = queries.withColumn("_asked", F.concat(F.lit(prefix), F.col(query_text)))
    return nearest(chunks, embedder.encode(asked, "_asked", normalise=False), k, id_col=id_col, metric="cosine")


def neighbours_of(corpus: DataFrame, wanted: DataFrame, k: int = 5, *, id_col: str = "chunk_id",
                  metric: str = "cosine") -> DataFrame:
    """Nearest rows of given corpus rows, themselves left out (``wanted`` has ``id_col``)."""
    asked = corpus.join(wanted.select(id_col), id_col, "left_semi").withColumnRenamed(id_col, "query_id")
    return nearest(corpus, asked, k, id_col=id_col, metric=metric, skip_self=True)


def pair_similarity(pairs: DataFrame, left: str, right: str, embedder: Embedder) -> DataFrame:
    """Similarity of the two texts of each row."""
    both = embedder.encode(embedder.encode(pairs, left, "_l"), right, "_r")
    return both.withColumn("similarity", vx.cosine("_l", "_r")).drop("_l", "_r")


def at_least(hits: DataFrame, min_score: float, score: str = "score") -> DataFrame:
    """Only hits that reach a score."""
    return hits.filter(F.col(score) >= min_score)


def score_confidence(hits: DataFrame, depth: int = 5) -> DataFrame:
    """Per query: best score, mean of the first ``depth``, distance from rank 1 to rank ``depth``."""
    return hits.filter(F.col("rank") <= depth).groupBy("query_id").agg(
        F.max("score").alias("max_score"),
        F.avg("score").alias("mean_score"),
        (F.max("score") - F.min("score")).alias("spread"))


def with_fallback(semantic: DataFrame, keyword: DataFrame, min_score: float, min_spread: float,
                  depth: int = 5) -> DataFrame:
    """Keyword rows for the queries whose semantic scores are low or flat, semantic rows for the rest."""
    low = (F.col("max_score") < min_score) | (F.col("spread") < min_spread)
    judged = score_confidence(semantic, depth).withColumn("low_confidence", low)
    unsure = judged.filter("low_confidence").select("query_id")
    both = ("query_id", "id", "rank")
    return stack(
        semantic.join(unsure, "query_id", "left_anti").select(*both, F.lit("semantic").alias("method")),
        keyword.join(unsure, "query_id", "left_semi").select(*both, F.lit("keyword").alias("method")),
    )


def centroids(corpus: DataFrame, category: str, vector: str = "embedding") -> DataFrame:
    """``(category, embedding)``: the mean vector of each category."""
    places = corpus.select(category, F.posexplode(vector).alias("pos", "x"))
    means = places.groupBy(category, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy(category).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("embedding"))


def closest_centroids(corpus: DataFrame, category: str, k: int = 1, vector: str = "embedding") -> DataFrame:
    """For each category the ``k`` categories with the most similar mean vector."""
    means = centroids(corpus, category, vector)
    return nearest(means, means.withColumnRenamed(category, "query_id"), k, id_col=category,
                   metric="cosine", skip_self=True)

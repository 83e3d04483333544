"""BM25 and keyword search.

A bounded batch of queries is answered by two passes over the corpus: document
frequencies of the query terms, then scoring inside each task (see ``scan``).
Nothing but those frequencies and ``k`` rows per query and task is shuffled.

A stored index is two tables: ``postings(term, chunk_id, dl, tf)`` and one row
of corpus statistics. With it, or with more queries than the bound, scoring is a
join on the term: a batch touches only the postings of its own terms, and
Catalyst moves that semi-join below the aggregation that makes the postings.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marlstone.functions import text as tx
from marlstone.operators.patterns import Finder, contained
from marlstone.operators.ranking import pad_with_first, top_k
from marlstone.operators.scan import NO_SCORE, SCORE_CELLS, as_ids, hit_schema, parts_of, scan_top_k
from marlstone.session import stack, staged

# The usual BM25 parameters and the share of the mean idf that
# replaces a negative idf in the "okapi" variant.
K1, B, OKAPI_EPSILON = 1.5, 0.75, 0.25
# Most (query, term) rows and most queries that are sent to every task.
TERM_BLOCK, QUERY_BLOCK = 200_000, 4096
# Most different bags of terms, if there are more queries than that.
BAG_BLOCK = 32_768
PAIRS_AT_ONCE = 1_000_000
# Most words of a corpus whose query words a task keeps in mind.
KNOWN_WORDS = 50_000


class LexicalIndex(NamedTuple):
    postings: DataFrame
    stats: DataFrame

    def save(self, path: str, buckets: int = 64) -> None:
        """Write both tables; postings are clustered by term so that term filters skip row groups."""
        self.postings.repartitionByRange(buckets, "term", "chunk_id").sortWithinPartitions("term").write.mode(
            "overwrite").parquet(f"{path}/postings")
        self.stats.write.mode("overwrite").parquet(f"{path}/stats")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LexicalIndex":
        return LexicalIndex(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/stats"))


def _terms(text: str) -> Column:
    """The terms of a text; a null text has none, and counts as a chunk of length 0."""
    return F.coalesce(tx.tokens(text), F.array().cast("array<string>"))


def lexical_index(corpus: DataFrame, id_col: str = "chunk_id", text: str = "content") -> LexicalIndex:
    """Term counts per chunk, and the number and mean length of chunks."""
    cut = corpus.select(F.col(id_col).alias("chunk_id"), _terms(text).alias("toks")).withColumn(
        "dl", F.size("toks"))
    postings = cut.select("chunk_id", "dl", F.explode("toks").alias("term")).groupBy(
        "chunk_id", "dl", "term").agg(F.count("*").alias("tf"))
    stats = corpus.select(F.size(_terms(text)).alias("dl")).agg(
        F.count("*").alias("n"), F.avg("dl").alias("avgdl"))
    return LexicalIndex(postings, stats)


def term_frequencies(postings: DataFrame) -> DataFrame:
    """``(term, df)``: in how many chunks a term occurs."""
    return postings.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def query_terms(queries: DataFrame, text: str = "text") -> DataFrame:
    """``(query_id, term, qf)``: a repeated query term counts again."""
    return queries.select("query_id", F.explode(tx.tokens(text)).alias("term")).groupBy(
        "query_id", "term").agg(F.count("*").alias("qf"))


def bm25_scores(index: LexicalIndex, queries: DataFrame, k1: float = K1, b: float = B,
                variant: str = "plus_one", text: str = "text") -> DataFrame:
    """``(query_id, chunk_id, score)`` for every chunk that shares a term with the query.

    ``plus_one`` has ``ln((N - n + .5) / (n + .5) + 1)``, which is never negative;
    ``okapi`` has no ``+ 1`` and puts a share of the mean idf for negative values.
    """
    if variant not in ("plus_one", "okapi"):
        raise ValueError("variant must be 'plus_one' or 'okapi'")
    asked = query_terms(queries, text)
    used = index.postings.join(asked.select("term").distinct(), "term", "left_semi")
    n = index.stats.select("n").scalar()
    avgdl = index.stats.select("avgdl").scalar()
    odds = lambda n, df: (n - df + F.lit(0.5)) / (df + F.lit(0.5))
    df = F.col("df")
    if variant == "plus_one":
        idf = F.log(odds(n, df) + 1)
    else:
        every = term_frequencies(index.postings)
        mean_idf = every.agg(F.avg(F.log(odds(n, F.col("df"))))).scalar()
        raw = F.log(odds(n, df))
        idf = F.when(raw < 0, mean_idf * OKAPI_EPSILON).otherwise(raw)
    weights = asked.join(term_frequencies(used).select("term", idf.alias("idf")), "term").select(
        "query_id", "term", (F.col("qf") * F.col("idf")).alias("w"))
    tf = F.col("tf")
    saturated = tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / avgdl))
    return (
        used.select("chunk_id", "term", saturated.alias("s"))
        .join(weights, "term")
        .groupBy("query_id", "chunk_id")
        .agg(F.sum(F.col("w") * F.col("s")).alias("score"))
    )


class _TermMatrix:
    """Weights by term and query in rows of terms: the query side of a scan."""

    def __init__(self, rows: list[tuple], values: list[float]):
        self.terms = sorted({r[1] for r in rows})
        self.query_ids = sorted({r[0] for r in rows})
        place = {t: i for i, t in enumerate(self.terms)}
        column = {q: i for i, q in enumerate(self.query_ids)}
        term = np.array([place[r[1]] for r in rows], dtype=np.int64)
        order = np.argsort(term, kind="stable")
        self.query = np.array([column[r[0]] for r in rows], dtype=np.int64)[order]
        self.weight = np.array(values, dtype=np.float64)[order]
        self.start = np.searchsorted(term[order], np.arange(len(self.terms) + 1))

    def add_up(self, row: np.ndarray, term: np.ndarray, factor: np.ndarray, n_rows: int,
               live: np.ndarray | None = None) -> np.ndarray:
        """``scores[q, row]``: sum of ``factor * weight`` over the given (row, term) entries, where ``live[q, row]``."""
        sizes = self.start[term + 1] - self.start[term]
        shape = (len(self.query_ids), n_rows)
        total, met = np.zeros(shape[0] * n_rows), np.zeros(shape[0] * n_rows, dtype=bool)
        ends = np.cumsum(sizes)
        first = 0
        while first < len(term):  # a bounded number of (entry, query) pairs at a time
            last = max(first + 1, int(np.searchsorted(ends, ends[first] - sizes[first] + PAIRS_AT_ONCE, "right")))
            part = sizes[first:last]
            entry = np.repeat(np.arange(first, last), part)
            offset = np.arange(len(entry)) - np.repeat(np.cumsum(part) - part, part)
            at = self.start[term][entry] + offset
            if live is not None:
                kept = live[self.query[at], row[entry]]
                at, entry = at[kept], entry[kept]
            cell = self.query[at] * n_rows + row[entry]
            np.add.at(total, cell, factor[entry] * self.weight[at])
            met[cell] = True
            first = last
        total[~met] = NO_SCORE
        return np.round(total.reshape(shape), 9)


def _list_lengths(lists: pa.Array) -> np.ndarray:
    return np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)


def _few_terms(queries: DataFrame, text: str) -> list[tuple] | None:
    """``(query_id, term, qf)`` rows if they are no more than ``TERM_BLOCK``."""
    rows = query_terms(queries, text).limit(TERM_BLOCK + 1).collect()
    return None if len(rows) > TERM_BLOCK else [(r["query_id"], r["term"], r["qf"]) for r in rows]


def _bounded(rows: list[tuple] | None) -> list[tuple] | None:
    """The rows if their queries are few enough to be sent to every task."""
    return None if rows is None or len({r[0] for r in rows}) > QUERY_BLOCK else rows


def _bounded_terms(queries: DataFrame, text: str) -> list[tuple] | None:
    """``(query_id, term, qf)`` rows if they are few enough to be sent to every task."""
    return _bounded(_few_terms(queries, text))


def _alike(rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Queries of the same terms become one, named by a number: its rows, and ``(number, query_id)`` of every query."""
    bags: dict = {}
    for query, term, qf in rows:
        bags.setdefault(query, []).append((term, qf))
    number: dict[tuple, int] = {}
    named = [(number.setdefault(tuple(sorted(bag)), len(number)), query) for query, bag in bags.items()]
    return [(no, term, qf) for bag, no in number.items() for term, qf in bag], named


class _Weighted(NamedTuple):
    """The asked terms with their weights, and what the corpus says of its lengths."""

    rows: list[tuple]
    weights: list[float]
    avgdl: float


def _weighted(cut: DataFrame, rows: list[tuple], variant: str, merged: DataFrame | None = None) -> _Weighted:
    """One pass for the document frequencies of the asked terms. ``merged`` has postings that are counted too."""
    spark = cut.sparkSession
    # The empty word stands for "every chunk": its row carries the corpus totals.
    asked = spark.createDataFrame([(t,) for t in {r[1] for r in rows} | {""}], "term string")
    seen = cut.select(F.size("toks").alias("dl"), F.explode(
        F.array_append(F.array_distinct("toks"), F.lit(""))).alias("term"))
    if merged is not None:
        seen = stack(seen, merged.select("dl", "term"))
    counts = {r["term"]: r for r in seen.join(asked, "term", "left_semi").groupBy("term").agg(
        F.count("*").alias("df"), F.sum("dl").alias("dl")).collect()}
    n = counts[""]["df"] if "" in counts else 0
    avgdl = counts[""]["dl"] / n if n else 1.0
    rows = [r for r in rows if r[1] in counts]
    df = np.array([counts[r[1]]["df"] for r in rows], dtype=np.float64)
    odds = (n - df + 0.5) / (df + 0.5)
    if variant == "plus_one":
        idf = np.log(odds + 1)
    else:
        every = cut.select(F.explode(F.array_distinct("toks")).alias("t")).groupBy("t").agg(F.count("*").alias("df"))
        log_odds = F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        mean_idf = every.agg(F.avg(log_odds).alias("m")).first()["m"]
        idf = np.where(np.log(odds) < 0, OKAPI_EPSILON * (mean_idf or 0.0), np.log(odds))
    return _Weighted(rows, [r[2] * float(i) for r, i in zip(rows, idf)], avgdl)


def _bm25_scorer(asked: _Weighted, matrix: _TermMatrix, k1: float, b: float):
    """Scores of a batch ``(id, terms)``."""
    vocabulary, avgdl = pa.array(matrix.terms, pa.string()), asked.avgdl

    def score(batch: pa.RecordBatch) -> np.ndarray:
        lists = batch.column(1)
        dl = _list_lengths(lists)
        place = pc.index_in(lists.flatten(), value_set=vocabulary).fill_null(-1).to_numpy()
        row = np.repeat(np.arange(len(dl)), dl)[place >= 0]
        entry, tf = np.unique(row * len(vocabulary) + place[place >= 0], return_counts=True)
        row, term = entry // len(vocabulary), entry % len(vocabulary)
        factor = tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl[row] / avgdl))
        return matrix.add_up(row, term, factor, len(dl))

    return score


def _scan_bm25(corpus: DataFrame, rows: list[tuple], query_type, k: int, id_col: str, content: str, k1: float,
               b: float, variant: str) -> DataFrame:
    """One pass for the document frequencies of the asked terms, one for the scores."""
    cut = corpus.select(F.col(id_col).alias("chunk_id"), _terms(content).alias("toks"))
    asked = _weighted(cut, rows, variant)
    schema = hit_schema(query_type, "chunk_id", cut.schema["chunk_id"].dataType)
    if not asked.rows:
        return corpus.sparkSession.createDataFrame([], schema).withColumn("rank", F.lit(0))
    matrix = _TermMatrix(asked.rows, asked.weights)
    return scan_top_k(cut, schema, as_ids(matrix.query_ids), k, _bm25_scorer(asked, matrix, k1, b))


def every_score(corpus: DataFrame, queries: DataFrame, k1: float = K1, b: float = B, text: str = "text") -> DataFrame:
    """``(query_id, chunk_id, score)`` of ``bm25_scores`` over a whole corpus (``chunk_id, content``), at 9 digits.

    A bounded batch of queries is scored where the documents lie, so the pairs are
    never shuffled. Only documents whose id comes more than once go through the
    postings, where rows of one id and length count as one document.
    """
    rows = _bounded_terms(queries, text)
    if not rows or any(r[0] is None for r in rows):
        return bm25_scores(lexical_index(corpus), queries, k1, b, text=text).withColumn("score", F.round("score", 9))
    spark, query_type = corpus.sparkSession, queries.schema["query_id"].dataType
    repeated = staged(corpus.groupBy("chunk_id").agg(F.count("*").alias("n")).filter("n > 1").select(
        F.col("chunk_id").alias("_id")))
    merged, once = None, corpus
    if not repeated.isEmpty():
        same = F.col("chunk_id").eqNullSafe(F.col("_id"))
        again, once = corpus.join(repeated, same, "left_semi"), corpus.join(repeated, same, "left_anti")
        postings = lexical_index(again).postings
        # Every row of the corpus counts in its totals, which stand under the empty word.
        totals = again.select(F.size(_terms("content")).alias("dl"), F.lit("").alias("term"))
        merged = stack(postings.select("dl", "term"), totals)
    cut = once.select("chunk_id", _terms("content").alias("toks"))
    asked = _weighted(cut, rows, "plus_one", merged)
    schema = hit_schema(query_type, "chunk_id", cut.schema["chunk_id"].dataType)
    if not asked.rows:
        return spark.createDataFrame([], schema)
    matrix = _TermMatrix(asked.rows, asked.weights)
    arrow, score, step = to_arrow_schema(schema), _bm25_scorer(asked, matrix, k1, b), max(1, SCORE_CELLS // len(matrix.query_ids))
    ids = pa.array(matrix.query_ids, arrow.types[0])

    def scan(batches):
        for batch in batches:
            for part in parts_of(batch, step):
                scores = score(part)
                query, row = np.nonzero(scores > NO_SCORE)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(query)), part.column(0).take(pa.array(row)), pa.array(scores[query, row])], names=arrow.names)

    scored = cut.mapInArrow(scan, schema)
    if merged is None:
        return scored
    weights = spark.createDataFrame([(r[0], r[1], w) for r, w in zip(asked.rows, asked.weights)],
                                    queries.select("query_id").schema.add("term", "string").add("w", "double"))
    tf = F.col("tf")
    share = tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / asked.avgdl))
    rest = postings.join(weights, "term").groupBy("query_id", "chunk_id").agg(F.round(F.sum(F.col("w") * share), 9).alias("score"))
    return stack(scored, rest)


def bm25_search(corpus: DataFrame, queries: DataFrame, k: int = 20, *, index: LexicalIndex | None = None,
                id_col: str = "chunk_id", content: str = "content", text: str = "text", pad: bool = False,
                k1: float = K1, b: float = B, variant: str = "plus_one") -> DataFrame:
    """Top-k chunks per query; ``pad`` fills short lists with zero-score chunks in id order.

    Scores are compared at 9 digits, ties go to the smaller id.
    """
    few = _few_terms(queries, text) if index is None else None
    rows = _bounded(few)
    alike, named = _alike(few) if few and rows is None else ([], [])
    if rows is None and 0 < len({r[0] for r in alike}) <= BAG_BLOCK:  # many queries, each different one is scored once
        names = corpus.sparkSession.createDataFrame(named, T.StructType([
            T.StructField("_no", T.LongType()), queries.schema["query_id"]]))
        found = _scan_bm25(corpus, alike, T.LongType(), k, id_col, content, k1, b, variant)
        hits = found.withColumnRenamed("query_id", "_no").join(names, "_no").select("query_id", "chunk_id", "score", "rank")
    elif rows is not None:
        hits = _scan_bm25(corpus, rows, queries.schema["query_id"].dataType, k, id_col, content, k1, b, variant)
    else:
        index = index or lexical_index(corpus, id_col, content)
        scores = bm25_scores(index, queries, k1, b, variant, text).withColumn("score", F.round("score", 9))
        hits = top_k(scores, k, F.col("score").desc(), F.col("chunk_id").asc())
    if not pad:
        return hits
    ids = corpus.select(F.col(id_col).alias("chunk_id"))
    padded = pad_with_first(hits, queries, ids, k, "chunk_id", "score")
    return top_k(padded, k, F.col("score").desc(), F.col("chunk_id").asc())


def _joined_fields(fields: tuple[str, ...]):
    return F.concat_ws(" ", *[F.coalesce(F.col(f), F.lit("")) for f in fields])


def keyword_hits(corpus: DataFrame, queries: DataFrame, *, id_col: str = "chunk_id",
                 fields: tuple[str, ...] = ("content",), text: str = "text") -> DataFrame:
    """``(query_id, <id_col>, hits)``: how many distinct query words occur as substrings.

    A word has no blank in it, so it occurs in a text exactly if it occurs in one
    of the text's words. Rows without a hit are not listed.
    """
    asked = queries.select("query_id", F.explode(F.array_distinct(tx.tokens(text))).alias("word"))
    said = corpus.select(F.col(id_col), F.explode(F.array_distinct(tx.tokens(_joined_fields(fields)))).alias("said"))
    return (
        contained(said, [id_col], "said", asked, "word")
        .join(asked, "word")
        .groupBy("query_id", id_col)
        .agg(F.count("*").alias("hits"))
    )


def _scan_keywords(corpus: DataFrame, rows: list[tuple], query_type, k: int, id_col: str,
                   fields: tuple[str, ...]) -> DataFrame:
    cut = corpus.select(id_col, F.array_distinct(tx.tokens(_joined_fields(fields))).alias("said"))
    matrix = _TermMatrix(rows, [1.0] * len(rows))
    terms, finders, known = list(matrix.terms), [], {}

    def inside(word: str) -> np.ndarray:
        if word not in known:
            if len(known) >= KNOWN_WORDS:
                known.clear()
            known[word] = np.fromiter(finders[0].inside(word), np.int32)
        return known[word]

    def score(batch: pa.RecordBatch) -> np.ndarray:
        if not finders:  # built once in each task
            finders.append(Finder(terms))
        sizes = _list_lengths(batch.column(1))
        coded = batch.column(1).flatten().dictionary_encode()
        found = [inside(w) for w in coded.dictionary.to_pylist()]
        counts = np.array([len(i) for i in found], dtype=np.int64)
        flat = np.concatenate([*found, np.zeros(0, np.int32)]).astype(np.int64)
        start = np.cumsum(counts) - counts
        code = coded.indices.to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        many = counts[code]
        offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        term = flat[np.repeat(start[code], many) + offset] if len(flat) else flat
        seen = np.zeros(len(sizes) * len(terms), dtype=bool)
        seen[np.repeat(row, many) * len(terms) + term] = True
        entry = np.nonzero(seen)[0]
        return matrix.add_up(entry // len(terms), entry % len(terms), np.ones(len(entry)), len(sizes))

    schema = hit_schema(query_type, id_col, cut.schema[id_col].dataType)
    return scan_top_k(cut, schema, as_ids(matrix.query_ids), k, score)


def keyword_search(corpus: DataFrame, queries: DataFrame, k: int = 5, *, id_col: str = "chunk_id",
                   fields: tuple[str, ...] = ("content",), text: str = "text") -> DataFrame:
    """Top-k by number of query words contained; rows without a hit fill up in id order."""
    rows = _bounded_terms(queries, text)
    if rows:
        found = _scan_keywords(corpus, rows, queries.schema["query_id"].dataType, k, id_col, fields)
        hits = found.select("query_id", id_col, F.col("score").cast("long").alias("hits"))
    else:
        every = keyword_hits(corpus, queries, id_col=id_col, fields=fields, text=text)
        hits = top_k(every, k, F.col("hits").desc(), F.col(id_col).asc())
    padded = pad_with_first(hits, queries, corpus, k, id_col, "hits")
    return top_k(padded, k, F.col("hits").desc(), F.col(id_col).asc())

"""Benchmark passages as queries against all documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.catalog.base import counts_sql, table, tokens_sql
from marlstone.operators import block_index, chunking, dense, evaluation, fusion, lexical
from marlstone.operators import graph as g
from marlstone.operators.embedding import HashingEmbedder
from marlstone.plans import retrieval as plan
from marlstone.session import shared_folder, spread, stack

EMBEDDER = HashingEmbedder(64)


def corpus(spark, sf) -> DataFrame:
    return spread(table(spark, sf, "documents")).select(
        F.col("doc_id").alias("chunk_id"), F.col("text").alias("content"), "lang", "source")


def questions(spark, sf) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def embedded(spark, sf) -> DataFrame:
    return EMBEDDER.encode(corpus(spark, sf), "content", normalise=False)


def bm25_stats(spark, sf):
    index = lexical.lexical_index(corpus(spark, sf))
    return index.stats.select("n", F.round("avgdl", 6).alias("avgdl"))


def term_frequencies(spark, sf):
    return lexical.term_frequencies(lexical.lexical_index(corpus(spark, sf)).postings)


def bm25_topk(spark, sf):
    return lexical.bm25_search(corpus(spark, sf), questions(spark, sf), 10)


def bm25_stored(spark, sf):
    """The index is built, written, opened again and searched."""
    path = f"{shared_folder(spark)}/marlstone-staged/{uuid.uuid4().hex}"
    block_index.build(corpus(spark, sf), near=("lang", "source")).save(path, files=8)
    return block_index.search(block_index.BlockIndex.load(spark, path), questions(spark, sf), 10)


def bm25_padded(spark, sf):
    """Every word of a passage is a query of its own: short lists are filled up."""
    asked = questions(spark, sf).select("query_id", F.posexplode(F.split("text", " ")).alias("at", "text"))
    asked = asked.withColumn("query_id", F.concat_ws("_", "query_id", "at"))
    return lexical.bm25_search(corpus(spark, sf), asked, 10, pad=True)


def bm25_okapi(spark, sf):
    return lexical.bm25_search(corpus(spark, sf), questions(spark, sf), 10, variant="okapi")


def keyword_topk(spark, sf):
    return lexical.keyword_search(corpus(spark, sf), questions(spark, sf), 5, fields=("source", "content"))


def vector_topk(spark, sf):
    return dense.vector_search(embedded(spark, sf), questions(spark, sf), EMBEDDER, 10)


def _two_lists(spark, sf, k=20):
    asked = questions(spark, sf)
    return {
        "bm25": lexical.bm25_search(corpus(spark, sf), asked, k),
        "vector": dense.vector_search(embedded(spark, sf), asked, EMBEDDER, k),
    }


def rrf_fusion(spark, sf):
    both = fusion.ranked_union(_two_lists(spark, sf))
    return fusion.reciprocal_rank_fusion(both, keep=10)


def rrf_weighted(spark, sf):
    both = fusion.ranked_union(_two_lists(spark, sf))
    return fusion.reciprocal_rank_fusion(both, weights={"bm25": 2.0, "vector": 0.5}, keep=10)


def weighted_fusion(spark, sf):
    lists = _two_lists(spark, sf)
    return fusion.weighted_scores(lists["vector"], lists["bm25"], 0.7, keep=10)


def ranker_compare(spark, sf):
    lists = _two_lists(spark, sf, 5)
    both = fusion.ranked_union(lists)
    fused = fusion.reciprocal_rank_fusion(both, keep=5)
    every = stack(both, fusion.ranked_union({"hybrid": fused}))
    return fusion.side_by_side(every, ["bm25", "vector", "hybrid"], 5)


def hybrid_retrieve(spark, sf):
    found = plan.hybrid_retrieve(embedded(spark, sf), questions(spark, sf))
    return found.select("query_id", "rank", "chunk_id", "first_rank", "rerank_score")


def hybrid_without_rerank(spark, sf):
    config = plan.RetrievalConfig(use_reranking=False)
    found = plan.hybrid_retrieve(embedded(spark, sf), questions(spark, sf), config)
    return found.select("query_id", "rank", "chunk_id", F.md5("content").alias("content_md5"))


def context_text(spark, sf):
    hits = fusion.with_text(lexical.bm25_search(corpus(spark, sf), questions(spark, sf), 4), corpus(spark, sf),
                            columns=("content", "source", "lang"))
    return plan.context_text(hits, questions(spark, sf), article="lang")


def low_confidence(spark, sf):
    hits = dense.vector_search(embedded(spark, sf), questions(spark, sf), EMBEDDER, 5)
    words = lexical.keyword_search(corpus(spark, sf), questions(spark, sf), 5)
    same = lambda df: df.withColumnRenamed("chunk_id", "id")
    return dense.with_fallback(same(hits), same(words), min_score=0.9, min_spread=0.05)


def scorer_correlation(spark, sf):
    lists = _two_lists(spark, sf)
    out = evaluation.scorer_correlation(lists["bm25"], lists["vector"], ["query_id", "chunk_id"])
    return out.withColumn("correlation", F.round("correlation", 6))


def source_graph(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Sources as articles that reference the languages they are written in."""
    docs = table(spark, sf, "documents")
    sources = docs.groupBy("source").agg(F.count("*").alias("summary")).withColumn("title", F.upper("source"))
    nodes = stack(g.make_nodes(sources, "Article", "source", None, ["title", "summary"]),
                  g.make_nodes(docs.select("lang").distinct(), "Concept", None, "lang"))
    edges = docs.select(F.concat(F.lit("Article:"), "source").alias("src"), F.lit("REFERENCES").alias("rel"),
                        F.concat(F.lit("Concept:"), "lang").alias("dst")).distinct()
    return nodes, edges


def graph_guided(spark, sf):
    """Only documents of sources that reference a language with an ``r`` in its name."""
    nodes, edges = source_graph(spark, sf)
    articles = plan.articles_of_concept(nodes, edges, "R")
    chunks = embedded(spark, sf).withColumnRenamed("source", "article")
    return plan.graph_guided(chunks, questions(spark, sf), articles, EMBEDDER)


def parents_of_hits(spark, sf):
    """BM25 over child chunks, answered with their parents."""
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    children, parents = chunking.chunk_parent_child(docs)
    children = children.withColumn("chunk_id", F.concat_ws("_", "parent_id", "child_idx"))
    hits = lexical.bm25_search(children, questions(spark, sf), 5)
    return chunking.parents_of_hits(hits, children, parents)


def chunk_search(spark, sf):
    """BM25 over fixed windows: the first thing to run."""
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    chunks = chunking.with_chunk_id(chunking.chunk_fixed(docs))
    return lexical.bm25_search(chunks, questions(spark, sf), 5)


QUERIES = {f.__name__: f for f in (
    bm25_stats, term_frequencies, bm25_topk, bm25_stored, bm25_padded, bm25_okapi, keyword_topk, vector_topk, rrf_fusion,
    rrf_weighted, weighted_fusion, ranker_compare, hybrid_retrieve, hybrid_without_rerank, context_text,
    low_confidence, scorer_correlation, graph_guided, parents_of_hits, chunk_search)}


def bm25_ctes(corpus: str = "SELECT doc_id AS chunk_id, text AS content FROM documents",
              queries: str = "SELECT item_id AS query_id, text FROM benchmark", okapi: bool = False) -> str:
    """CTEs ending in ``bm25_scores(query_id, chunk_id, score)``."""
    idf = "ln((n - df + 0.5) / (df + 0.5) + 1)"
    if okapi:
        raw = "ln((n - df + 0.5) / (df + 0.5))"
        idf = f"CASE WHEN {raw} < 0 THEN 0.25 * (SELECT avg({raw}) FROM df, st) ELSE {raw} END"
    return f"""
bm_c AS ({corpus}),
bm_q AS ({queries}),
bm_len AS (SELECT chunk_id, {tokens_sql('content')} AS l FROM bm_c),
st AS (SELECT count(*)::DOUBLE AS n, avg(len(l))::DOUBLE AS avgdl FROM bm_len),
tf AS (SELECT chunk_id, dl, term, count(*)::DOUBLE AS tf
       FROM (SELECT chunk_id, len(l) AS dl, unnest(l) AS term FROM bm_len) GROUP BY ALL),
df AS (SELECT term, count(*)::DOUBLE AS df FROM tf GROUP BY ALL),
qt AS (SELECT query_id, term, count(*) AS qf
       FROM (SELECT query_id, unnest({tokens_sql('text')}) AS term FROM bm_q) GROUP BY ALL),
w AS (SELECT query_id, qt.term, qf * ({idf}) AS w FROM qt JOIN df ON df.term = qt.term, st),
bm25_scores AS (
  SELECT query_id, chunk_id, round(sum(w * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 9) AS score
  FROM tf JOIN w ON w.term = tf.term, st GROUP BY ALL)"""


def ranked_cte(name: str, scores: str, k: int) -> str:
    return f"""
{name} AS (
  SELECT * FROM (SELECT query_id, chunk_id, score,
      row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM {scores})
  WHERE rank <= {k})"""


def vector_ctes(extra: str = "TRUE") -> str:
    """CTEs ending in ``vec_scores(query_id, chunk_id, score)``: hashed counts, cosine."""
    return f"""
{counts_sql('vd', f'(SELECT doc_id AS chunk_id, text FROM documents WHERE {extra})', 'chunk_id', 'text')},
{counts_sql('vq', '(SELECT item_id AS query_id, text FROM benchmark)', 'query_id', 'text')},
vec_dots AS (SELECT query_id, chunk_id, sum(vd.c * vq.c) AS d FROM vd JOIN vq ON vd.p = vq.p GROUP BY ALL),
vec_all AS (SELECT b.item_id AS query_id, x.doc_id AS chunk_id FROM benchmark b, documents x WHERE {extra}),
vec_scores AS (
  SELECT a.query_id, a.chunk_id, round(coalesce(d / (vd_norm.n * vq_norm.n), 0), 9) AS score
  FROM vec_all a LEFT JOIN vec_dots USING (query_id, chunk_id)
  LEFT JOIN vd_norm USING (chunk_id) LEFT JOIN vq_norm USING (query_id))"""


_LISTS = lambda k: f"WITH {bm25_ctes()}, {vector_ctes()}, {ranked_cte('b', 'bm25_scores', k)}, {ranked_cte('v', 'vec_scores', k)}"


def fused_cte(name: str, keep: int, wb: float = 1.0, wv: float = 1.0) -> str:
    return f"""
{name}_s AS (
  SELECT query_id, chunk_id, round(sum(w / (60 + rank)), 12) AS score, min(no * 1000 + rank) AS first_seen
  FROM (SELECT query_id, chunk_id, rank, 0 AS no, {wb}::DOUBLE AS w FROM b
        UNION ALL SELECT query_id, chunk_id, rank, 1, {wv}::DOUBLE FROM v) GROUP BY ALL),
{name} AS (
  SELECT * FROM (SELECT query_id, chunk_id, score,
    row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first_seen, chunk_id) AS rank FROM {name}_s)
  WHERE rank <= {keep})"""


_KEYWORD = lambda text: f"""
kq AS (SELECT item_id AS query_id, list_distinct({tokens_sql('text')}) AS l FROM benchmark),
kd AS (SELECT doc_id AS chunk_id, lower({text}) AS t FROM documents),
kh AS (SELECT query_id, chunk_id, len(list_filter(l, lambda w: contains(t, w))) AS hits FROM kq, kd),
kw AS (SELECT * FROM (SELECT query_id, chunk_id, hits,
        row_number() OVER (PARTITION BY query_id ORDER BY hits DESC, chunk_id) AS rank FROM kh) WHERE rank <= 5)"""  # noqa: E731

_OUT = "SELECT query_id, chunk_id, score, rank FROM"
_RERANK = """
shortlist AS (SELECT f.query_id, f.chunk_id, f.rank AS first_rank, s.score AS rerank_score
  FROM f JOIN vec_scores s USING (query_id, chunk_id)),
final AS (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY query_id ORDER BY rerank_score DESC, first_rank, chunk_id) AS rank FROM shortlist) WHERE rank <= 5)"""

_WORD_QUERIES = """
SELECT item_id || '_' || (i - 1) AS query_id, w[i] AS text
  FROM (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT item_id, string_split(text, ' ') AS w FROM benchmark))"""
SQL = {
    "bm25_stats": f"""
SELECT count(*) AS n, round(avg(len({tokens_sql('text')})), 6) AS avgdl FROM documents""",
    "term_frequencies": f"""
SELECT term, count(DISTINCT doc_id) AS df
FROM (SELECT doc_id, unnest({tokens_sql('text')}) AS term FROM documents) GROUP BY term""",
    "bm25_topk": f"WITH {bm25_ctes()}, {ranked_cte('b', 'bm25_scores', 10)} {_OUT} b",
    "bm25_stored": f"WITH {bm25_ctes()}, {ranked_cte('b', 'bm25_scores', 10)} {_OUT} b",
    "bm25_okapi": f"WITH {bm25_ctes(okapi=True)}, {ranked_cte('b', 'bm25_scores', 10)} {_OUT} b",
    "bm25_padded": f"""
WITH {bm25_ctes(queries=_WORD_QUERIES)},
padded AS (SELECT q.query_id, c.chunk_id, coalesce(s.score, 0) AS score
  FROM bm_q q CROSS JOIN bm_c c LEFT JOIN bm25_scores s USING (query_id, chunk_id)),
{ranked_cte('b', 'padded', 10)} {_OUT} b""",
    "keyword_topk": f"WITH {_KEYWORD('''source || ' ' || text''')} SELECT query_id, chunk_id, hits, rank FROM kw",
    "vector_topk": f"WITH {vector_ctes()}, {ranked_cte('v', 'vec_scores', 10)} {_OUT} v",
    "rrf_fusion": f"{_LISTS(20)}, {fused_cte('f', 10)} {_OUT} f",
    "rrf_weighted": f"{_LISTS(20)}, {fused_cte('f', 10, 2.0, 0.5)} {_OUT} f",
    "weighted_fusion": f"""
{_LISTS(20)},
bs AS (SELECT *, min(score) OVER (PARTITION BY query_id) AS lo, max(score) OVER (PARTITION BY query_id) AS hi FROM b),
vs AS (SELECT *, min(score) OVER (PARTITION BY query_id) AS lo, max(score) OVER (PARTITION BY query_id) AS hi FROM v),
mix AS (SELECT query_id, chunk_id, round(
    0.7 * coalesce(CASE WHEN vs.hi = vs.lo THEN 1 ELSE (vs.score - vs.lo) / (vs.hi - vs.lo) END, 0)
    + 0.3 * coalesce(CASE WHEN bs.hi = bs.lo THEN 1 ELSE (bs.score - bs.lo) / (bs.hi - bs.lo) END, 0), 9) AS score
  FROM bs FULL JOIN vs USING (query_id, chunk_id)),
{ranked_cte('m', 'mix', 10)} {_OUT} m""",
    "ranker_compare": f"""
{_LISTS(5)}, {fused_cte('f', 5)},
places AS (SELECT DISTINCT query_id, rank FROM (
  SELECT query_id, rank FROM b UNION ALL SELECT query_id, rank FROM v UNION ALL SELECT query_id, rank FROM f))
SELECT query_id, rank, coalesce(b.chunk_id::VARCHAR, '-') AS bm25, coalesce(v.chunk_id::VARCHAR, '-') AS vector,
  coalesce(f.chunk_id::VARCHAR, '-') AS hybrid
FROM places LEFT JOIN b USING (query_id, rank) LEFT JOIN v USING (query_id, rank) LEFT JOIN f USING (query_id, rank)""",
    "hybrid_retrieve": f"""
{_LISTS(20)}, {fused_cte('f', 20)}, {_RERANK}
SELECT query_id, rank, chunk_id, first_rank, rerank_score FROM final""",
    "hybrid_without_rerank": f"""
{_LISTS(20)}, {fused_cte('f', 5)}
SELECT query_id, rank, chunk_id, md5(text) AS content_md5 FROM f JOIN documents ON doc_id = chunk_id""",
    "context_text": f"""
WITH {bm25_ctes()}, {ranked_cte('b', 'bm25_scores', 4)},
lines AS (SELECT query_id, rank, '[' || source || ' — ' || lang || ']' || chr(10) || text AS line
  FROM b JOIN documents ON doc_id = chunk_id),
joined AS (SELECT query_id, string_agg(line, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS c
  FROM lines GROUP BY query_id)
SELECT q.query_id, coalesce(c, 'No relevant regulation text found.') AS context
FROM bm_q q LEFT JOIN joined j ON j.query_id = q.query_id""",
    "low_confidence": f"""
WITH {vector_ctes()}, {ranked_cte('v', 'vec_scores', 5)}, {_KEYWORD('text')},
conf AS (SELECT query_id, max(score) AS hi, max(score) - min(score) AS spread FROM v GROUP BY query_id),
unsure AS (SELECT query_id FROM conf WHERE hi < 0.9 OR spread < 0.05)
SELECT query_id, chunk_id AS id, rank, 'semantic' AS method FROM v WHERE query_id NOT IN (SELECT query_id FROM unsure)
UNION ALL
SELECT query_id, chunk_id, rank, 'keyword' FROM kw WHERE query_id IN (SELECT query_id FROM unsure)""",
    "scorer_correlation": f"""
{_LISTS(20)}
SELECT round(corr(b.score, v.score), 6) AS correlation, count(*) AS pairs FROM b JOIN v USING (query_id, chunk_id)""",
    "graph_guided": f"""
WITH {vector_ctes("source IN (SELECT source FROM documents WHERE contains(lower(lang), 'r'))")},
{ranked_cte('v', 'vec_scores', 3)}
SELECT query_id, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context
FROM v JOIN documents ON doc_id = chunk_id GROUP BY query_id""",
    "chunk_search": f"""
WITH {bm25_ctes(corpus='''
  SELECT 'chunk_' || doc_id || '_' || (s // 450) AS chunk_id, substring(text, s + 1, 500) AS content
  FROM (SELECT doc_id, text, unnest(range(0, length(text), 450)) AS s FROM documents)
  WHERE regexp_matches(substring(text, s + 1, 500), '\\S')''')}, {ranked_cte('b', 'bm25_scores', 5)} {_OUT} b""",
}

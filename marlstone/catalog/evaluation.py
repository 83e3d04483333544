"""Recall, reciprocal rank, reports and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.catalog import retrieval as r
from marlstone.catalog.base import table
from marlstone.operators import evaluation as ev
from marlstone.operators import fusion, lexical, rerank
from marlstone.operators.embedding import HashingEmbedder
from marlstone.session import stack, staged


METHODS = ["bm25", "vector", "hybrid"]


def _golden(spark, sf) -> DataFrame:
    """Each benchmark passage is its own right answer."""
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.array("text").alias("contexts"))
    return ev.golden_pairs(items).select("query_id", "context")


def _methods(spark, sf) -> DataFrame:
    lists = r._two_lists(spark, sf)
    both = fusion.ranked_union(lists)
    fused = fusion.reciprocal_rank_fusion(both, keep=20)
    every = stack(both, fusion.ranked_union({"hybrid": fused})).filter(F.col("rank") <= 5)
    return fusion.with_text(every, r.corpus(spark, sf)).withColumnRenamed("ranker", "method")


def recall_at_5(spark, sf):
    return ev.recall_at_k(_methods(spark, sf), _golden(spark, sf), METHODS)


def recall_exact(spark, sf):
    """The documents that hold a passage are its right answers, matched as whole texts."""
    held = fusion.with_text(_holders(spark, sf), r.corpus(spark, sf))
    golden = ev.in_corpus(held.select("query_id", F.col("content").alias("context")).distinct(), r.corpus(spark, sf))
    return ev.recall_per_pair(_methods(spark, sf), golden, METHODS, match="exact").groupBy("method").agg(
        F.sum("hit").alias("hits"), F.count("*").alias("pairs"))


def _before_after(spark, sf) -> DataFrame:
    both = fusion.ranked_union(r._two_lists(spark, sf))
    fused = fusion.reciprocal_rank_fusion(both, keep=20)
    short = fusion.with_text(fused, r.corpus(spark, sf)).join(r.questions(spark, sf), "query_id")
    after = rerank.rerank(short, rerank.CosineScorer(HashingEmbedder(64)), 5)
    pick = lambda df, m: df.select("query_id", F.lit(m).alias("method"), "rank", "content")
    return stack(pick(short, "fused"), pick(after, "reranked"))


def mrr_at_5(spark, sf):
    out = ev.mrr_at_k(_before_after(spark, sf), _golden(spark, sf), ["fused", "reranked"])
    return out.withColumn("mrr", F.round("mrr", 6))


def mrr_gain(spark, sf):
    per_question = ev.reciprocal_ranks(_before_after(spark, sf), _golden(spark, sf), ["fused", "reranked"])
    out = ev.mrr_gain(per_question, "fused", "reranked")
    return out.select(*[F.round(c, 6).alias(c) for c in ("mrr_before", "mrr_after", "improvement_pct")],
                      "improved", "degraded")


def score_gap(spark, sf):
    """BM25 scores of documents that hold the passage, and of all other scored documents."""
    scored = lexical.every_score(r.corpus(spark, sf), r.questions(spark, sf))
    holders = staged(_holders(spark, sf))  # by its measured size it is broadcast, so the scores stay where they are
    joined = scored.join(holders, ["query_id", "chunk_id"], "left")
    out = ev.score_gap(joined, F.coalesce("holds", F.lit(False)))
    return out.select(*[F.round(c, 6).alias(c) for c in ("relevant_mean", "other_mean", "gap")],
                      "n_relevant", "n_other")


def _holders(spark, sf) -> DataFrame:
    """All documents that hold the first 80 characters of a passage, or whose own first 80 a passage holds."""
    return ev.holders(r.corpus(spark, sf), _golden(spark, sf)).withColumn("holds", F.lit(True))


def score_histogram(spark, sf):
    """Distribution of the scores a first stage gives, in 20 ranges."""
    scored = lexical.every_score(r.corpus(spark, sf), r.questions(spark, sf))
    out = ev.histogram(scored.withColumn("score", F.round("score", 6)), "score", 20)
    return out.select("bin", "n", F.round("bin_start", 4).alias("bin_start"), F.round("bin_end", 4).alias("bin_end"))


def value_histogram(spark, sf):
    out = ev.histogram(table(spark, sf, "events"), "value", 15, by="event_type")
    return out.select("event_type", "bin", "n", F.round("bin_start", 4).alias("bin_start"),
                      F.round("bin_end", 4).alias("bin_end"))


def latency_summary(spark, sf):
    """Event values as latencies, event types as methods."""
    out = ev.latency_summary(table(spark, sf, "events"), "event_type", "value", "view")
    return out.select("method", "trials", *[F.round(c, 6).alias(c) for c in ("mean", "p99", "ratio")])


def _verdicts(spark, sf, docs: DataFrame | None = None) -> DataFrame:
    """Labels as verdicts, grouped into questions by the source of the document."""
    docs = table(spark, sf, "documents") if docs is None else docs
    judged = table(spark, sf, "labels").join(docs.select("doc_id", "source"), "doc_id")
    return judged.select(F.col("source").alias("query_id"), F.explode(F.array(
        F.struct(F.lit("faithfulness").alias("metric"), (F.col("quality") == 1).alias("verdict")),
        F.struct(F.lit("context_precision").alias("metric"), (F.col("toxic") == 0).alias("verdict")),
        F.struct(F.lit("context_recall").alias("metric"),
                 ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("verdict")))).alias("v")).select(
        "query_id", "v.metric", "v.verdict")


def judged_metrics(spark, sf):
    return ev.judged_metrics(_verdicts(spark, sf)).withColumn("score", F.round("score", 6))


def eval_report(spark, sf):
    """English documents as the new run, all documents as the baseline; one metric is missing."""
    english = table(spark, sf, "documents").filter(F.col("lang") == "en")
    run = ev.judged_metrics(_verdicts(spark, sf, english))
    out = ev.threshold_report(run, ev.judged_metrics(_verdicts(spark, sf)))
    return out.select("metric", "threshold", "status", *[F.round(c, 6).alias(c) for c in ("score", "baseline", "delta")])


def mean_of_metrics(spark, sf):
    return ev.mean_of_metrics(ev.judged_metrics(_verdicts(spark, sf))).select(F.round("average", 6).alias("average"))


def complete_answers(spark, sf):
    """First user messages as questions, the reply as the answer where the thread has one."""
    said = table(spark, sf, "conversations")
    golden = said.filter(F.col("role") == "user").select(
        F.concat_ws("_", "conv_id", "turn").alias("query_id"), F.col("text").alias("question"),
        F.lit("").alias("ground_truth"), F.array(F.md5("text")).alias("contexts"))
    answers = said.filter(F.col("role") == "assistant").select(
        F.concat_ws("_", "conv_id", (F.col("turn") - 1).cast("string")).alias("query_id"),
        F.col("text").alias("answer"),
        F.when(F.length("text") > 300, F.array(F.md5("text"))).alias("retrieved"))
    out = ev.complete_answers(golden, answers)
    return out.select("query_id", "question", "answer", F.get("contexts", F.lit(0)).alias("context"))


def answer_relevancy(spark, sf):
    answers = complete_answers(spark, sf)
    return ev.answer_relevancy(answers, HashingEmbedder(64)).withColumn("score", F.round("score", 6))


QUERIES = {f.__name__: f for f in (
    recall_at_5, recall_exact, mrr_at_5, mrr_gain, score_gap, score_histogram, value_histogram, latency_summary,
    judged_metrics, eval_report, mean_of_metrics, complete_answers, answer_relevancy)}

_HIT = "(contains(d.text, substring(b.text, 1, 80)) OR contains(b.text, substring(d.text, 1, 80)))"
_METHODS = f"""
{r._LISTS(20)}, {r.fused_cte('f', 20)},
methods AS (SELECT 'bm25' AS method, query_id, chunk_id, rank FROM b UNION ALL
  SELECT 'vector', query_id, chunk_id, rank FROM v UNION ALL SELECT 'hybrid', query_id, chunk_id, rank FROM f),
shown AS (SELECT * FROM methods WHERE rank <= 5),
grid AS (SELECT DISTINCT m.method, b.item_id AS query_id FROM benchmark b, shown m)"""
_BEFORE_AFTER = f"""
{r._LISTS(20)}, {r.fused_cte('f', 20)}, {r._RERANK},
runs AS (SELECT 'fused' AS method, query_id, chunk_id, rank FROM f WHERE rank <= 5 UNION ALL
  SELECT 'reranked', query_id, chunk_id, rank FROM final),
best AS (SELECT method, query_id, min(rank) AS best FROM runs JOIN documents d ON d.doc_id = chunk_id
  JOIN benchmark b ON b.item_id = query_id WHERE {_HIT} GROUP BY ALL),
rr AS (SELECT m.method, b.item_id AS query_id, coalesce(1.0::DOUBLE / best, 0) AS rr
  FROM benchmark b CROSS JOIN (SELECT DISTINCT method FROM runs) m
  LEFT JOIN best ON best.method = m.method AND best.query_id = b.item_id)"""
_SCORES = f"WITH {r.bm25_ctes().replace('round(sum(w * tf', '(sum(w * tf').replace('), 9) AS score', ')) AS score')}"
_VERDICTS = """
verdicts AS (
  SELECT source AS query_id, 'faithfulness' AS metric, (quality = 1)::INT AS v FROM labels JOIN documents USING (doc_id)
  UNION ALL SELECT source, 'context_precision', (toxic = 0)::INT FROM labels JOIN documents USING (doc_id)
  UNION ALL SELECT source, 'context_recall', (quality = 1 AND toxic = 0)::INT FROM labels JOIN documents USING (doc_id)),
judged AS (SELECT metric, avg(s) AS score FROM (
  SELECT metric, query_id, avg(v) AS s FROM verdicts GROUP BY ALL) GROUP BY metric)"""
_BINS = lambda src, x, bins, keys: f"""
e AS (SELECT min({x})::DOUBLE AS lo, max({x})::DOUBLE AS hi FROM {src})
SELECT {keys} bin, count(*) AS n, round(any_value(lo) + bin * (any_value(hi) - any_value(lo)) / {bins}, 4) AS bin_start,
  round(any_value(lo) + (bin + 1) * (any_value(hi) - any_value(lo)) / {bins}, 4) AS bin_end
FROM (SELECT *, CAST(least(floor(({x} - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin FROM {src}, e)
GROUP BY {keys} bin"""  # noqa: E731
_ANSWERS = """
answers AS (
  SELECT u.conv_id || '_' || u.turn AS query_id, u.text AS question, coalesce(a.text, '') AS answer,
    CASE WHEN length(a.text) > 300 THEN md5(a.text) ELSE md5(u.text) END AS context
  FROM conversations u LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')"""

SQL = {
    "recall_at_5": f"""
{_METHODS}
SELECT g.method, avg(CASE WHEN h.query_id IS NULL THEN 0.0 ELSE 1.0 END) AS recall, count(*) AS pairs
FROM grid g LEFT JOIN (
  SELECT DISTINCT method, query_id FROM shown JOIN documents d ON d.doc_id = chunk_id
  JOIN benchmark b ON b.item_id = query_id WHERE {_HIT}) h ON h.method = g.method AND h.query_id = g.query_id
GROUP BY g.method""",
    "recall_exact": f"""
{_METHODS},
gold AS (SELECT DISTINCT b.item_id AS query_id, d.text FROM documents d JOIN benchmark b ON {_HIT}),
pairs AS (SELECT DISTINCT m.method, g.query_id, g.text FROM gold g, shown m),
hit AS (SELECT DISTINCT method, query_id, d.text FROM shown JOIN documents d ON d.doc_id = chunk_id)
SELECT p.method, CAST(count(h.text) AS BIGINT) AS hits, count(*) AS pairs
FROM pairs p LEFT JOIN hit h ON h.method = p.method AND h.query_id = p.query_id AND h.text = p.text
GROUP BY p.method""",
    "mrr_at_5": f"{_BEFORE_AFTER} SELECT method, round(avg(rr), 6) AS mrr, count(*) AS questions FROM rr GROUP BY method",
    "mrr_gain": f"""
{_BEFORE_AFTER},
p AS (SELECT query_id, max(CASE WHEN method = 'fused' THEN rr END) AS b, max(CASE WHEN method = 'reranked' THEN rr END) AS a
  FROM rr GROUP BY query_id)
SELECT round(avg(b), 6) AS mrr_before, round(avg(a), 6) AS mrr_after,
  round((avg(a) - avg(b)) / (avg(b) + 1e-9) * 100, 6) AS improvement_pct,
  count(*) FILTER (a > b) AS improved, count(*) FILTER (a < b) AS degraded FROM p""",
    "score_gap": f"""
{_SCORES},
holds AS (SELECT DISTINCT b.item_id AS query_id, d.doc_id AS chunk_id FROM documents d JOIN benchmark b ON {_HIT}),
j AS (SELECT s.score, h.query_id IS NOT NULL AS good FROM bm25_scores s
  LEFT JOIN holds h ON h.query_id = s.query_id AND h.chunk_id = s.chunk_id)
SELECT round(avg(score) FILTER (good), 6) AS relevant_mean, round(avg(score) FILTER (NOT good), 6) AS other_mean,
  round(avg(score) FILTER (good) - avg(score) FILTER (NOT good), 6) AS gap,
  count(*) FILTER (good) AS n_relevant, count(*) FILTER (NOT good) AS n_other FROM j""",
    "score_histogram": f"""
{_SCORES}, s6 AS (SELECT round(score, 6) AS score FROM bm25_scores), {_BINS('s6', 'score', 20, '')}""",
    "value_histogram": f"WITH {_BINS('events', 'value', 15, 'event_type,')}",
    "latency_summary": """
SELECT event_type AS method, count(*) AS trials, round(avg(value), 6) AS mean,
  round(quantile_cont(value::DOUBLE, 0.99), 6) AS p99,
  round(avg(value) / (SELECT avg(value) FROM events WHERE event_type = 'view'), 6) AS ratio
FROM events GROUP BY event_type""",
    "judged_metrics": f"WITH {_VERDICTS} SELECT metric, round(score, 6) AS score FROM judged",
    "eval_report": f"""
WITH {_VERDICTS},
judged_en AS (SELECT source AS query_id, quality = 1 AS good, toxic = 0 AS clean
  FROM labels JOIN documents USING (doc_id) WHERE lang = 'en'),
run AS (SELECT metric, avg(s) AS score FROM (SELECT metric, query_id, avg(CAST(v AS INTEGER)) AS s FROM (
  SELECT query_id, 'faithfulness' AS metric, good AS v FROM judged_en
  UNION ALL SELECT query_id, 'context_precision', clean FROM judged_en
  UNION ALL SELECT query_id, 'context_recall', good AND clean FROM judged_en) GROUP BY ALL) GROUP BY metric),
t(metric, threshold) AS (VALUES ('faithfulness', 0.8::DOUBLE), ('answer_relevancy', 0.8::DOUBLE),
  ('context_precision', 0.7::DOUBLE), ('context_recall', 0.7::DOUBLE))
SELECT t.metric, threshold, CASE WHEN coalesce(r.score, 0) >= threshold THEN 'PASS' ELSE 'FAIL' END AS status,
  round(coalesce(r.score, 0), 6) AS score, round(coalesce(b.score, 0), 6) AS baseline,
  round(coalesce(r.score, 0) - coalesce(b.score, 0), 6) AS delta
FROM t LEFT JOIN run r ON r.metric = t.metric LEFT JOIN judged b ON b.metric = t.metric""",
    "mean_of_metrics": f"WITH {_VERDICTS} SELECT round(avg(score), 6) AS average FROM judged",
    "complete_answers": f"WITH {_ANSWERS} SELECT query_id, question, answer, context FROM answers",
    "answer_relevancy": f"""
WITH {_ANSWERS},
{r.counts_sql('ca', '(SELECT query_id AS k, question AS t FROM answers)', 'k', 't')},
{r.counts_sql('cb', '(SELECT query_id AS k, answer AS t FROM answers)', 'k', 't')},
dots AS (SELECT ca.k, sum(ca.c * cb.c) AS d FROM ca JOIN cb ON ca.k = cb.k AND ca.p = cb.p GROUP BY ALL)
SELECT 'answer_relevancy' AS metric, round(avg(coalesce(d / (ca_norm.n * cb_norm.n), 0)), 6) AS score
FROM answers LEFT JOIN dots ON dots.k = query_id LEFT JOIN ca_norm ON ca_norm.k = query_id
LEFT JOIN cb_norm ON cb_norm.k = query_id""",
}

"""Stored vectors: norms, profiles, nearest rows of category means, confidence, PCA."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.catalog.base import counts_sql, table
from marlstone.functions import vector as vx
from marlstone.operators import dense, profile
from marlstone.operators.embedding import HashingEmbedder
from marlstone.session import spread


def _vectors(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "embedding", "label")


def _means(spark, sf) -> DataFrame:
    return dense.centroids(_vectors(spark, sf), "label").withColumnRenamed("label", "query_id")


def norm_check(spark, sf):
    out = profile.norm_check(_vectors(spark, sf))
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


def vector_profile(spark, sf):
    out = profile.vector_profile(_vectors(spark, sf), "vec_id")
    return out.select("vec_id", "dim", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in
                                         ("norm", "max_value", "min_value", "mean_value")])


def unit_vectors(spark, sf):
    """Twice the vector scaled to length 1 again, and the cosine of the two."""
    longer = F.transform("embedding", lambda x: x * F.lit(2).cast("float"))
    unit = vx.unit(longer)
    return _vectors(spark, sf).select(
        "vec_id", F.round(vx.l2_norm(unit), 6).alias("norm"), F.round(vx.cosine(longer, "embedding"), 6).alias("cos"),
        F.round(vx.dot(longer, "embedding"), 6).alias("dot"))


def cosine_topk(spark, sf):
    """The ten vectors nearest to the mean of each category."""
    return dense.nearest(_vectors(spark, sf), _means(spark, sf), 10, id_col="vec_id", metric="cosine")


def dot_topk(spark, sf):
    return dense.nearest(_vectors(spark, sf), _means(spark, sf), 10, id_col="vec_id")


def cosine_topk_filtered(spark, sf):
    """Only one category is searched; the filter reaches the scan."""
    pool = dense.filtered(_vectors(spark, sf), "3", category_col="label")
    return dense.nearest(pool, _means(spark, sf), 10, id_col="vec_id", metric="cosine")


def neighbours_of_medoids(spark, sf):
    """The vector nearest to each category mean, and its own nearest vectors without itself."""
    medoids = dense.nearest(_vectors(spark, sf), _means(spark, sf), 1, id_col="vec_id", metric="cosine")
    return dense.neighbours_of(_vectors(spark, sf), medoids, 5, id_col="vec_id")


def score_confidence(spark, sf):
    out = dense.score_confidence(cosine_topk(spark, sf))
    return out.select("query_id", *[F.round(c, 6).alias(c) for c in ("max_score", "mean_score", "spread")])


def hits_above_score(spark, sf):
    return dense.at_least(cosine_topk(spark, sf), 0.3).groupBy("query_id").agg(F.count("*").alias("hits"))


def centroid_pairs(spark, sf):
    """For each category the category with the most similar mean."""
    return dense.closest_centroids(_vectors(spark, sf), "label")


def semantic_search(spark, sf):
    """English documents nearest to the benchmark passages, with the checks and columns of a search page."""
    embedder = HashingEmbedder(64)
    docs = spread(table(spark, sf, "documents")).select(
        F.col("doc_id").alias("id"), F.col("source").alias("title"), F.col("text").alias("abstract"),
        F.col("lang").alias("category"), F.lit(2020).alias("year"))
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return dense.semantic_search(embedder.encode(docs, "abstract"), embedder.encode(asked, "text"), 5, "en", 2000,
                                 metric="cosine")


def reply_similarity(spark, sf):
    """Similarity of every user message and the reply to it."""
    said = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    reply = said.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    pairs = said.filter(F.col("role") == "user").join(reply, ["conv_id", "turn"])
    out = dense.pair_similarity(pairs, "text", "reply", HashingEmbedder(64))
    return out.select("conv_id", "turn", F.round("similarity", 5).alias("similarity"))


def pca_2d(spark, sf):
    return profile.pca(_vectors(spark, sf), "vec_id")


QUERIES = {f.__name__: f for f in (
    norm_check, vector_profile, unit_vectors, cosine_topk, dot_topk, cosine_topk_filtered, neighbours_of_medoids,
    score_confidence, hits_above_score, centroid_pairs, semantic_search, reply_similarity, pca_2d)}

_D = "embedding::DOUBLE[]"


def _nearest(metric: str, k: int, where: str = "TRUE", name: str = "hits") -> str:
    dot = "list_dot_product(e, m)"
    score = dot if metric == "dot" else f"{dot} / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(m, m)))"
    return f"""
places AS (SELECT label, unnest({_D}) AS x, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings),
mean_of AS (SELECT label, p, avg(x) AS m FROM places GROUP BY ALL),
means AS (SELECT label AS query_id, list(m ORDER BY p) AS m FROM mean_of GROUP BY label),
scored AS (SELECT query_id, vec_id, round({score}, 9) AS score
  FROM (SELECT vec_id, label, {_D} AS e FROM embeddings WHERE {where}), means),
{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored) WHERE rank <= {k})"""


_ALL = "SELECT query_id, vec_id, score, rank FROM"

SQL = {
    "norm_check": f"""
SELECT round(min(n), 6) AS min_norm, round(max(n), 6) AS max_norm, round(avg(n), 6) AS mean_norm
FROM (SELECT sqrt(list_dot_product({_D}, {_D})) AS n FROM embeddings)""",
    "vector_profile": f"""
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim, round(sqrt(list_dot_product({_D}, {_D})), 6) AS norm,
  round(list_max({_D}), 6) AS max_value, round(list_min({_D}), 6) AS min_value, round(list_avg({_D}), 6) AS mean_value
FROM embeddings""",
    "unit_vectors": f"""
SELECT vec_id, 1.0::DOUBLE AS norm, 1.0::DOUBLE AS cos, round(2 * list_dot_product({_D}, {_D}), 6) AS dot
FROM embeddings""",
    "cosine_topk": f"WITH {_nearest('cosine', 10)} {_ALL} hits",
    "dot_topk": f"WITH {_nearest('dot', 10)} {_ALL} hits",
    "cosine_topk_filtered": f"WITH {_nearest('cosine', 10, 'label = 3')} {_ALL} hits",
    "neighbours_of_medoids": f"""
WITH {_nearest('cosine', 1)},
wanted AS (SELECT DISTINCT vec_id FROM hits),
pairs AS (SELECT a.vec_id AS query_id, b.vec_id,
    round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])
      / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]))
         * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 9) AS score
  FROM embeddings a JOIN wanted w ON a.vec_id = w.vec_id, embeddings b WHERE a.vec_id <> b.vec_id)
SELECT query_id, vec_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 5""",
    "score_confidence": f"""
WITH {_nearest('cosine', 5)}
SELECT query_id, round(max(score), 6) AS max_score, round(avg(score), 6) AS mean_score,
  round(max(score) - min(score), 6) AS spread FROM hits GROUP BY query_id""",
    "hits_above_score": f"""
WITH {_nearest('cosine', 10)} SELECT query_id, count(*) AS hits FROM hits WHERE score >= 0.3 GROUP BY query_id""",
    "centroid_pairs": f"""
WITH {_nearest('cosine', 1)},
pairs AS (SELECT a.query_id, b.query_id AS label, round(list_dot_product(a.m, b.m)
    / (sqrt(list_dot_product(a.m, a.m)) * sqrt(list_dot_product(b.m, b.m))), 9) AS score
  FROM means a, means b WHERE a.query_id <> b.query_id)
SELECT query_id, label, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, label) AS rank FROM pairs) WHERE rank = 1""",
    "semantic_search": f"""
WITH {counts_sql('vd', "(SELECT doc_id AS id, text FROM documents WHERE lang = 'en')", 'id', 'text')},
{counts_sql('vq', '(SELECT item_id AS query_id, text FROM benchmark)', 'query_id', 'text')},
dots AS (SELECT query_id, id, sum(vd.c * vq.c) AS d FROM vd JOIN vq ON vd.p = vq.p GROUP BY ALL),
scored AS (SELECT item_id AS query_id, doc_id AS id, source AS title, substring(documents.text, 1, 120) || '...' AS snippet,
    coalesce(d / (vd_norm.n * vq_norm.n), 0) AS s
  FROM benchmark JOIN documents ON lang = 'en'
  LEFT JOIN dots ON dots.query_id = item_id AND dots.id = doc_id
  LEFT JOIN vd_norm ON vd_norm.id = doc_id LEFT JOIN vq_norm ON vq_norm.query_id = item_id)
SELECT query_id, rank, id, title, snippet, round_even(round(s, 9), 4) AS score,
  (SELECT count(*) FROM documents WHERE lang = 'en') AS filter_pool
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 7) DESC, id) AS rank FROM scored)
WHERE rank <= 5""",
    "reply_similarity": f"""
WITH pairs AS (SELECT a.conv_id, a.turn, a.text AS t, b.text AS r FROM conversations a
  JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user'),
keyed AS (SELECT conv_id || '_' || turn AS k, * FROM pairs),
{counts_sql('ca', '(SELECT k, t FROM keyed)', 'k', 't')},
{counts_sql('cb', '(SELECT k, r FROM keyed)', 'k', 'r')},
dots AS (SELECT ca.k, sum(ca.c * cb.c) AS d FROM ca JOIN cb ON ca.k = cb.k AND ca.p = cb.p GROUP BY ALL)
SELECT conv_id, turn, round(coalesce(d / (ca_norm.n * cb_norm.n), 0), 5) AS similarity
FROM keyed LEFT JOIN dots USING (k) LEFT JOIN ca_norm USING (k) LEFT JOIN cb_norm USING (k)""",
}

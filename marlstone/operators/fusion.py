"""Fusing and comparing ranked lists: rows ``(query_id, ranker, chunk_id, rank[, score])``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.operators.ranking import top_k
from marlstone.session import stack, staged


def ranked_union(rankings: dict[str, DataFrame], id_col: str = "chunk_id") -> DataFrame:
    """The lists one below the other; ``ranker_no`` keeps their order."""
    parts = [
        df.select("query_id", F.lit(name).alias("ranker"), F.lit(no).alias("ranker_no"),
                  F.col(id_col).alias("chunk_id"), "rank")
        for no, (name, df) in enumerate(rankings.items())
    ]
    return stack(*parts)


def reciprocal_rank_fusion(rankings: DataFrame, k: int = 60, weights: dict[str, float] | None = None,
                           keep: int | None = None) -> DataFrame:
    """Sum of ``weight / (k + rank)`` per chunk; equal sums keep the order of first appearance."""
    share = F.lit(1.0) / (F.lit(k) + F.col("rank"))
    if weights:
        share = share * F.coalesce(
            *[F.when(F.col("ranker") == name, F.lit(float(w))) for name, w in weights.items()], F.lit(1.0))
    fused = rankings.groupBy("query_id", "chunk_id").agg(
        F.round(F.sum(share), 12).alias("score"),
        F.min(F.struct("ranker_no", "rank")).alias("_first"))
    return top_k(fused, keep, F.col("score").desc(), F.col("_first").asc(), F.col("chunk_id").asc()).drop("_first")


def weighted_scores(semantic: DataFrame, keyword: DataFrame, alpha: float = 0.5,
                    keep: int | None = None) -> DataFrame:
    """``alpha * semantic + (1 - alpha) * keyword`` after scaling each list to 0..1 per query.

    A chunk missing from a list gets 0 there; a list of equal scores scales to 1.
    """

    def scaled(df: DataFrame, name: str) -> DataFrame:
        range_ = df.groupBy("query_id").agg(F.min("score").alias("low"), F.max("score").alias("high"))
        value = F.when(F.col("high") == F.col("low"), F.lit(1.0)).otherwise(
            (F.col("score") - F.col("low")) / (F.col("high") - F.col("low")))
        return df.join(range_, "query_id").select("query_id", "chunk_id", value.alias(name))

    both = scaled(semantic, "_s").join(scaled(keyword, "_k"), ["query_id", "chunk_id"], "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    mixed = both.select("query_id", "chunk_id",
                        F.round(alpha * zero("_s") + (1 - alpha) * zero("_k"), 9).alias("score"))
    return top_k(mixed, keep, F.col("score").desc(), F.col("chunk_id").asc())


def side_by_side(rankings: DataFrame, rankers: list[str], depth: int) -> DataFrame:
    """One row per query and position, one column per ranker; ``-`` where a list is shorter."""
    wide = rankings.filter(F.col("rank") <= depth).groupBy("query_id", "rank").pivot("ranker", rankers).agg(
        F.first(F.col("chunk_id").cast("string")))
    return wide.select("query_id", "rank", *[F.coalesce(F.col(r), F.lit("-")).alias(r) for r in rankers])


def with_text(ranked: DataFrame, corpus: DataFrame, id_col: str = "chunk_id",
              columns: tuple[str, ...] = ("content",)) -> DataFrame:
    """Texts of ranked ids; ids that are not in the corpus drop out.

    The ranking is written first: it is a few rows per query, and by its measured size
    it is broadcast, so that the texts are not shuffled for it.
    """
    ranked = staged(ranked)
    return ranked.join(corpus.select(F.col(id_col).alias("chunk_id"), *columns), "chunk_id")

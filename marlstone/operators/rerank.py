"""Second-stage scoring of (query, candidate) rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions import vector as vx
from marlstone.operators.embedding import Embedder
from marlstone.operators.ranking import top_k


class PairScorer:
    """Scores a (query text, passage text) row."""

    def score(self, query: Column, passage: Column) -> Column:
        raise NotImplementedError


class CosineScorer(PairScorer):
    """Cosine of the two embedded texts."""

    def __init__(self, embedder: Embedder):
        self.embedder = embedder

    def score(self, query: Column, passage: Column) -> Column:
        return vx.cosine(self.embedder.vector(query, False), self.embedder.vector(passage, False))


class ModelScorer(PairScorer):
    """A supplied model: ``load()`` returns ``predict(list of [query, passage]) -> scores``."""

    def __init__(self, load: Callable[[], Callable[[list[list[str]]], np.ndarray]]):
        self.load = load

    def score(self, query: Column, passage: Column) -> Column:
        load = self.load

        @F.arrow_udf(T.DoubleType())
        def predict(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            model = load()
            for queries, passages in batches:
                pairs = [list(p) for p in zip(queries.to_pylist(), passages.to_pylist())]
                yield pa.array(np.asarray(model(pairs), dtype=np.float64))

        return predict(query, passage)


def rerank(candidates: DataFrame, scorer: PairScorer, k: int | None = 5, *, query_text: str = "text",
           passage: str = "content", id_col: str = "chunk_id", min_score: float | None = None) -> DataFrame:
    """Score the candidates, order by the score (earlier rank first on ties), keep ``k``.

    The rank before goes to ``first_rank``, the score to ``rerank_score``.
    """
    scored = candidates.withColumnRenamed("rank", "first_rank").withColumn(
        "rerank_score", F.round(scorer.score(F.col(query_text), F.col(passage)), 9))
    if min_score is not None:
        scored = scored.filter(F.col("rerank_score") >= min_score)
    return top_k(scored, k, F.col("rerank_score").desc(), F.col("first_rank").asc(), F.col(id_col).asc())

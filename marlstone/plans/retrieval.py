"""Hybrid retrieval, context texts and graph-guided retrieval for a table of queries."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.operators import chunking
from marlstone.operators.dense import vector_search
from marlstone.operators.embedding import Embedder, HashingEmbedder
from marlstone.operators.fusion import ranked_union, reciprocal_rank_fusion, with_text
from marlstone.operators.lexical import LexicalIndex, bm25_search
from marlstone.operators.rerank import CosineScorer, PairScorer, rerank

NO_PASSAGE = "No relevant regulation text found."
# Most article summaries that are put into one context text.


@dataclass
class RetrievalConfig:
    """Settings of a retrieval run; the defaults are the usual ones for this work."""

    embedding_model: str = "hashing"
    embedding_prefix: str = ""
    chunking_strategy: str = "recursive"
    chunk_size: int = 500
    chunk_overlap: int = 50
    initial_retrieval_k: int = 20
    final_top_k: int = 5
    use_bm25: bool = True
    use_reranking: bool = True
    reranking_model: str = "cosine"
    rrf_k: int = 60
    pad: bool = False
    embedder: Embedder = field(default_factory=HashingEmbedder)
    scorer: PairScorer | None = None


def build_chunks(docs: DataFrame, config: RetrievalConfig, text: str = "text") -> DataFrame:
    """Cut, number and embed documents: the table that retrieval runs on."""
    sized = config.chunking_strategy in ("fixed", "recursive", "markdown")
    options = {"size": config.chunk_size} if config.chunking_strategy != "semantic" else {}
    if sized:
        options["overlap"] = config.chunk_overlap
    cut = chunking.chunk_documents(docs, config.chunking_strategy, text=text, **options)
    return config.embedder.encode(chunking.with_chunk_id(cut), "content")


def candidates(chunks: DataFrame, queries: DataFrame, config: RetrievalConfig,
               index: LexicalIndex | None = None) -> DataFrame:
    """First stage: vector top-k, fused with BM25 top-k if that is switched on."""
    k = config.initial_retrieval_k
    dense = vector_search(chunks, queries, config.embedder, k, prefix=config.embedding_prefix)
    if not config.use_bm25:
        return dense
    lexical = bm25_search(chunks, queries, k, index=index, pad=config.pad)
    both = ranked_union({"bm25": lexical, "vector": dense})
    return reciprocal_rank_fusion(both, config.rrf_k, keep=k)


def hybrid_retrieve(chunks: DataFrame, queries: DataFrame, config: RetrievalConfig | None = None,
                    index: LexicalIndex | None = None, columns: tuple[str, ...] = ("content",)) -> DataFrame:
    """``(query_id, rank, chunk_id, content, ...)``: candidates, reranked and cut to the final k.

    ``chunks`` has ``chunk_id, content, embedding``; ``queries`` has ``query_id, text``.
    """
    config = config or RetrievalConfig()
    shortlist = with_text(candidates(chunks, queries, config, index), chunks, columns=columns)
    if not config.use_reranking:
        return shortlist.filter(F.col("rank") <= config.final_top_k)
    scorer = config.scorer or CosineScorer(config.embedder)
    return rerank(shortlist.join(queries.select("query_id", "text"), "query_id"), scorer, config.final_top_k)


def context_text(hits: DataFrame, queries: DataFrame, depth: int = 4, source: str = "source",
                 article: str | None = None) -> DataFrame:
    """``(query_id, context)``: the first passages with their headers; a fixed sentence when there are none."""
    note = F.col(article) if article else F.lit(None).cast("string")
    lines = hits.filter(F.col("rank") <= depth).select(
        "query_id", "rank", tx.headed_passage(F.col(source), note, F.col("content")).alias("passage"))
    joined = lines.groupBy("query_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "passage"))), lambda p: p["passage"]),
            tx.PASSAGE_RULE).alias("context"))
    return queries.select("query_id").join(joined, "query_id", "left").select(
        "query_id", F.coalesce("context", F.lit(NO_PASSAGE)).alias("context"))


def articles_of_concept(nodes: DataFrame, edges: DataFrame, concept: str, *, rel: str = "REFERENCES",
                        article_label: str = "Article", concept_label: str = "Concept") -> DataFrame:
    """``(id, title, summary)`` of the articles that reference a concept (substring of its name)."""
    meant = nodes.filter((F.col("label") == concept_label) & tx.contains_ignore_case("name", F.lit(concept)))
    sources = edges.filter(F.col("rel") == rel).join(
        meant.select(F.col("node_key").alias("dst")), "dst", "left_semi").select("src").distinct()
    return nodes.filter(F.col("label") == article_label).join(
        sources, F.col("node_key") == F.col("src"), "left_semi").select(
        "id", F.col("props")["title"].alias("title"), F.col("props")["summary"].alias("summary"))


def graph_guided(chunks: DataFrame, queries: DataFrame, articles: DataFrame, embedder: Embedder, *,
                 article: str = "article", k: int = 3) -> DataFrame:
    """``(query_id, context)`` from the best chunks of the given articles.

    ``articles`` comes from ``articles_of_concept``; no article means no filter.
    Where no chunk is found the summaries of all the articles stand in, joined to one text.
    """
    some = not articles.isEmpty()
    pool = chunks
    if some:
        pool = chunks.join(articles.select(F.col("id").alias(article)), article, "left_semi")
    hits = with_text(vector_search(pool, queries, embedder, k), pool)
    passages = hits.groupBy("query_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "content"))),
                                 lambda p: p["content"]), tx.PASSAGE_RULE).alias("passages"))
    digest = F.lit(None).cast("string")
    if some:
        known = lambda c: F.coalesce(F.col(c), F.lit(""))
        line = F.concat(F.lit("["), F.col("id"), F.lit("] "), known("title"), F.lit("\n"), known("summary"))
        digest = articles.agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("id", line.alias("line")))), lambda p: p["line"]),
            "\n\n")).scalar()
    return queries.select("query_id").join(passages, "query_id", "left").select(
        "query_id", F.coalesce("passages", digest).alias("context"))

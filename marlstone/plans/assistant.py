"""Answering a table of messages: route each, then fetch the context of each route in bulk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.operators import conversations as cv
from marlstone.operators.dense import vector_search
from marlstone.operators.embedding import Embedder
from marlstone.operators.fusion import with_text
from marlstone.operators.graph import related_for_requests
from marlstone.plans.medallion import fund_lookup
from marlstone.plans.retrieval import context_text
from marlstone.session import stack, staged


def routed(messages: DataFrame, routes: cv.Routes = cv.Routes(), text: str = "text") -> DataFrame:
    """Messages with ``route`` and the arguments the routes read from the text."""
    said = F.coalesce(F.col(text), F.lit(""))
    return messages.withColumn("route", cv.route(said, routes)).withColumn(
        "fund_id", cv.fund_id(said)).withColumn("year", cv.asked_year(said)).withColumn(
        "entity", cv.asked_entity(said))


def graph_context(asked: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(query_id, context)``: at most 25 neighbour lines per message."""
    found = related_for_requests(nodes, edges, asked)
    line = tx.graph_line(F.col("name"), F.col("type"), F.col("relationship"), F.col("direction"))
    texts = found.select("query_id", "rank", line.alias("line")).groupBy("query_id").agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "line"))), lambda p: p["line"]), "\n").alias("c"))
    nothing = F.lit("- ? (?) [? / ?]")
    return asked.select("query_id").join(texts, "query_id", "left").select(
        "query_id", F.coalesce("c", nothing).alias("context"))


def fund_context(asked: DataFrame, funds: DataFrame, metrics: DataFrame,
                 columns: tuple[str, ...] = ("coverage_ratio_pct",)) -> DataFrame:
    """``(query_id, context)``: the fund's figures as JSON, or the error text."""
    same = F.upper(F.col("fund_id").cast("string"))
    answers = fund_lookup(asked, funds.withColumn("fund_id", same), metrics.withColumn("fund_id", same), columns)
    context = F.coalesce("error", F.to_json(F.struct("fund_id", "fund_name", "year", *columns)))
    return asked.select("query_id", "fund_id", "year").join(answers, ["fund_id", "year"]).select(
        "query_id", context.alias("context"))


def answer_messages(messages: DataFrame, *, chunks: DataFrame, embedder: Embedder, nodes: DataFrame,
                    edges: DataFrame, funds: DataFrame, metrics: DataFrame,
                    routes: cv.Routes = cv.Routes()) -> DataFrame:
    """``(query_id, route, context)`` for messages ``(query_id, text)``.

    The routed messages are written first, since every route reads them several times.
    """
    all_ = staged(routed(messages, routes))
    of = lambda r: all_.filter(F.col("route") == r)
    label = lambda df, r: df.select("query_id", F.lit(r).alias("route"), "context")
    hits = with_text(vector_search(chunks, of(cv.RAG), embedder, 4), chunks, columns=("content", "source"))
    human = of(cv.HUMAN).select("query_id", F.lit(cv.REVIEW_REQUESTED).alias("context"))
    return stack(
        label(context_text(hits, of(cv.RAG)), cv.RAG),
        label(fund_context(of(cv.SQL), funds, metrics), cv.SQL),
        label(graph_context(of(cv.GRAPH), nodes, edges), cv.GRAPH),
        label(human, cv.HUMAN),
    )

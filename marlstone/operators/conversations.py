"""Routing messages and keeping conversation state.

A thread may hold any share of all messages, so its history stays in rows
ordered by ``turn`` and everything per thread is an aggregate that is combined
in the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.session import stack

HUMAN, GRAPH, SQL, RAG = "human_checkpoint", "graph_query", "sql_query", "rag_retrieval"
REVIEW_REQUESTED = "HUMAN_REVIEW_REQUESTED"

# Whole words, any case, that choose a route; the first that matches wins.
ESCALATION_WORDS = "human|escalate|unsure|help|confused|expert"
GRAPH_WORDS = "related|relationship|linked|reference|entity|concept|connect|who|what references|graph|network"
SQL_WORDS = r"fund|return|asset|aum|performance|allocation|metric|data|report|quarter|year|2\d{3}|portfolio"
# What a fund question asks for when it does not say.
DEFAULT_FUND, DEFAULT_YEAR = "NL_ABP", 2023
FUND_PATTERN = r"(?iU)\b(NL_\w+|fund[_\s]\w+)\b"
YEAR_PATTERN = r"(?U)\b(20\d{2})\b"
CAPITALISED = r"(?U)\b([A-Z][a-zA-Z]+(?:\s[A-Z][a-zA-Z]+)*)\b"
# Marks of a text that needs a citation.
CITATION_MARKS = ("IORP", "FTK", "Article", "Art.", "directive")


@dataclass(frozen=True)
class Routes:
    """Word alternations per route."""

    escalation: str = ESCALATION_WORDS
    graph: str = GRAPH_WORDS
    sql: str = SQL_WORDS


def has_word(text: Column, words: str) -> Column:
    """Whole-word search in any case; letters and digits of all scripts belong to words."""
    return text.rlike(rf"(?iU)\b({words})\b")


def route(text: Column, routes: Routes = Routes()) -> Column:
    said = F.coalesce(text, F.lit(""))
    return (
        F.when(has_word(said, routes.escalation), HUMAN)
        .when(has_word(said, routes.graph), GRAPH)
        .when(has_word(said, routes.sql), SQL)
        .otherwise(RAG)
    )


def fund_id(text: Column, default: str = DEFAULT_FUND, pattern: str = FUND_PATTERN) -> Column:
    return F.upper(tx.first_group(text, pattern, default))


def asked_year(text: Column, default: int = DEFAULT_YEAR) -> Column:
    return tx.first_group(text, YEAR_PATTERN, str(default)).cast("int")


def asked_entity(text: Column) -> Column:
    """The first capitalised phrase, else the first 60 characters."""
    return tx.first_group(text, CAPITALISED, F.substring(text, 1, 60))


def needs_citation(text: Column) -> Column:
    marked = F.lit(False)
    for mark in CITATION_MARKS:
        marked = marked | F.contains(text, F.lit(mark))
    return F.coalesce(marked, F.lit(False))


def with_citation(text: Column, note: str) -> Column:
    """The text, followed by a citation note where one is needed."""
    return F.when(needs_citation(text), F.concat(text, F.lit("\n\n"), F.lit(note))).otherwise(text)


def last_user_message(messages: DataFrame) -> DataFrame:
    """``(conv_id, text)``: the latest user message of every thread, ``''`` without one."""
    return messages.groupBy("conv_id").agg(
        F.coalesce(F.max_by(F.when(F.col("role") == "user", F.col("text")),
                            F.when(F.col("role") == "user", F.col("turn"))), F.lit("")).alias("text"))


def state_columns(routes: Routes = Routes()) -> list[Column]:
    """Aggregates that make up a thread's state; the same in batch and in a stream."""
    is_user = F.col("role") == "user"
    user_turn = F.when(is_user, F.col("turn"))
    way = F.when(is_user, route(F.col("text"), routes))
    last_way = F.max_by(way, user_turn)
    return [
        F.count("*").alias("n_messages"),
        F.max("turn").alias("last_turn"),
        F.count_if(way != HUMAN).alias("tool_calls"),
        F.coalesce(last_way == HUMAN, F.lit(False)).alias("requires_human"),
        last_way.alias("last_route"),
    ]


def conversation_state(messages: DataFrame, routes: Routes = Routes()) -> DataFrame:
    """Per thread: messages, last turn, tool calls so far, and the last routing decision."""
    return messages.groupBy("conv_id").agg(*state_columns(routes))


def assemble_prompts(messages: DataFrame, system: str, contexts: DataFrame | None = None) -> DataFrame:
    """``(conv_id, position, role, content)``: the prompt of every thread as rows.

    Position 0 is the system text, 1 the retrieved context (left out when empty
    or when a review was requested), ``2 + turn`` the messages.
    """
    threads = messages.select("conv_id").distinct()
    parts = [threads.select("conv_id", F.lit(0).cast("long").alias("position"), F.lit("system").alias("role"),
                         F.lit(system).alias("content"))]
    if contexts is not None:
        known = contexts.filter((F.coalesce("context", F.lit("")) != "") & (F.col("context") != REVIEW_REQUESTED))
        parts.append(known.join(threads, "conv_id", "left_semi").select(
            "conv_id", F.lit(1).cast("long").alias("position"), F.lit("system").alias("role"),
            F.concat(F.lit("Retrieved context:\n\n"), F.col("context")).alias("content")))
    return stack(*parts, messages.select(
        "conv_id", (F.col("turn") + 2).cast("long").alias("position"), "role", F.col("text").alias("content")))

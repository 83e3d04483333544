"""Routing and state of the conversations.

The messages are invented text in four languages, so the route words are short
words of those languages instead of the English domain words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.catalog import graph as cg
from marlstone.catalog import medallion as cm
from marlstone.catalog import retrieval as cr
from marlstone.catalog.base import counts_sql, table
from marlstone.operators import conversations as cv
from marlstone.plans import assistant

ROUTES = cv.Routes(escalation="avec|ento", graph="was|und|que", sql="the|le|la")
SYSTEM = "You answer from the given context."


def messages(spark, sf) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")


def route_messages(spark, sf):
    users = messages(spark, sf).filter(F.col("role") == "user")
    return users.select("conv_id", "turn", cv.route(F.col("text"), ROUTES).alias("route"))


def default_routes(spark, sf):
    """The domain words over all messages."""
    return messages(spark, sf).groupBy(cv.route(F.col("text")).alias("route")).agg(F.count("*").alias("n"))


def message_arguments(spark, sf):
    m = messages(spark, sf)
    year = F.concat("text", F.lit(" in "), (F.lit(1990) + F.col("turn") * 5).cast("string"))
    fund = F.when(F.col("turn") % 2 == 0, F.concat("text", F.lit(" nl_f"), "conv_id")).otherwise(F.col("text"))
    return m.select("conv_id", "turn", cv.asked_year(year).alias("year"), cv.fund_id(fund).alias("fund_id"),
                    cv.asked_entity(F.lower("text")).alias("short_entity"))


def citation_flags(spark, sf):
    m = messages(spark, sf)
    said = F.when(F.col("turn") % 3 == 1, F.concat("text", F.lit(" Art. 3"))).otherwise(F.col("text"))
    return m.select("conv_id", "turn", cv.needs_citation(said).alias("needs_citation"),
                    F.md5(cv.with_citation(said, "Sources: A")).alias("text_md5"))


def last_user_message(spark, sf):
    return cv.last_user_message(messages(spark, sf))


def conversation_state(spark, sf):
    return cv.conversation_state(messages(spark, sf), ROUTES)


def prompt_assembly(spark, sf):
    state = cv.conversation_state(messages(spark, sf), ROUTES)
    contexts = state.select("conv_id", F.when(F.col("requires_human"), cv.REVIEW_REQUESTED).otherwise(
        F.concat(F.lit("via "), F.coalesce("last_route", F.lit("nothing")))).alias("context"))
    return cv.assemble_prompts(messages(spark, sf), SYSTEM, contexts)


def assistant_answers(spark, sf):
    """The last user message of every thread, routed and answered."""
    asked = cv.last_user_message(messages(spark, sf)).select(F.col("conv_id").alias("query_id"), "text")
    year = F.concat("text", F.lit(" 20"), F.lpad((F.col("query_id") % 5).cast("string"), 2, "0"))
    asked = asked.withColumn("text", F.concat(year, F.lit(" nl_"), "query_id"))
    funds = cm._dim(spark, sf).withColumn("fund_id", F.concat(F.lit("NL_"), "fund_id"))
    metrics = cm.stg_funds(spark, sf).select(
        F.concat(F.lit("NL_"), "fund_id").alias("fund_id"), (F.col("reporting_year") + 5).alias("reporting_year"),
        "coverage_ratio_pct")
    chunks = cr.embedded(spark, sf)
    return assistant.answer_messages(asked, chunks=chunks, embedder=cr.EMBEDDER, nodes=cg.nodes(spark, sf),
                                     edges=cg.edges(spark, sf), funds=funds, metrics=metrics, routes=ROUTES)


QUERIES = {f.__name__: f for f in (
    route_messages, default_routes, message_arguments, citation_flags, last_user_message, conversation_state,
    prompt_assembly, assistant_answers)}


_EDGE = "[^\\p{L}\\p{N}\\p{M}_]"


def _word(words: str, text: str = "text") -> str:
    return f"regexp_matches({text}, '(?i)(^|{_EDGE})({words})($|{_EDGE})')"


def route_sql(text: str = "text") -> str:
    return f"""CASE WHEN {_word(ROUTES.escalation, text)} THEN 'human_checkpoint'
  WHEN {_word(ROUTES.graph, text)} THEN 'graph_query' WHEN {_word(ROUTES.sql, text)} THEN 'sql_query'
  ELSE 'rag_retrieval' END"""


STATE_SQL = f"""
routed AS (SELECT *, CASE WHEN role = 'user' THEN {route_sql()} END AS way FROM conversations),
state AS (
  SELECT conv_id, count(*) AS n_messages, max(turn) AS last_turn,
    count(*) FILTER (way <> 'human_checkpoint') AS tool_calls,
    coalesce(arg_max(way, turn) FILTER (way IS NOT NULL) = 'human_checkpoint', FALSE) AS requires_human,
    arg_max(way, turn) FILTER (way IS NOT NULL) AS last_route
  FROM routed GROUP BY conv_id)"""
_LAST = """
last_user AS (SELECT conv_id, coalesce(arg_max(text, turn) FILTER (role = 'user'), '') AS text
  FROM conversations GROUP BY conv_id)"""

SQL = {
    "route_messages": f"SELECT conv_id, turn, {route_sql()} AS route FROM conversations WHERE role = 'user'",
    "default_routes": f"""
SELECT CASE WHEN {_word(cv.ESCALATION_WORDS)} THEN 'human_checkpoint' WHEN {_word(cv.GRAPH_WORDS)} THEN 'graph_query'
  WHEN {_word(cv.SQL_WORDS)} THEN 'sql_query' ELSE 'rag_retrieval' END AS route, count(*) AS n
FROM conversations GROUP BY route""",
    "message_arguments": """
SELECT conv_id, turn, CASE WHEN 1990 + turn * 5 BETWEEN 2000 AND 2099 THEN CAST(1990 + turn * 5 AS INTEGER) ELSE 2023 END AS year,
  CASE WHEN turn % 2 = 0 THEN 'NL_F' || conv_id ELSE 'NL_ABP' END AS fund_id,
  nullif(substring(lower(text), 1, 60), '') AS short_entity
FROM conversations""",
    "citation_flags": """
WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN text || ' Art. 3' ELSE text END AS t FROM conversations),
f AS (SELECT *, contains(t, 'IORP') OR contains(t, 'FTK') OR contains(t, 'Article') OR contains(t, 'Art.')
  OR contains(t, 'directive') AS needs_citation FROM c)
SELECT conv_id, turn, needs_citation,
  md5(CASE WHEN needs_citation THEN t || chr(10) || chr(10) || 'Sources: A' ELSE t END) AS text_md5 FROM f""",
    "last_user_message": f"WITH {_LAST} SELECT conv_id, text FROM last_user",
    "conversation_state": f"WITH {STATE_SQL} SELECT * FROM state",
    "assistant_answers": f"""
WITH {cm._FUNDS}, {cg._NODES}, {cg._EDGES}, {cg._WAYS}, {_LAST},
said AS (SELECT conv_id AS query_id, conv_id % 5 + 2000 AS year, 'NL_' || conv_id AS fund_id,
  text || ' 20' || lpad((conv_id % 5)::VARCHAR, 2, '0') || ' nl_' || conv_id AS text FROM last_user),
way AS (SELECT *, {route_sql()} AS route FROM said),
rag AS (SELECT query_id, text FROM way WHERE route = 'rag_retrieval'),
{counts_sql('vd', '(SELECT doc_id AS chunk_id, text FROM documents)', 'chunk_id', 'text')},
{counts_sql('vq', 'rag', 'query_id', 'text')},
dots AS (SELECT query_id, chunk_id, sum(vd.c * vq.c) AS d FROM vd JOIN vq ON vd.p = vq.p GROUP BY ALL),
scores AS (SELECT r.query_id, doc_id AS chunk_id, source, documents.text AS body,
    round(coalesce(d / (vd_norm.n * vq_norm.n), 0), 9) AS score
  FROM rag r CROSS JOIN documents LEFT JOIN dots ON dots.query_id = r.query_id AND dots.chunk_id = doc_id
  LEFT JOIN vd_norm ON vd_norm.chunk_id = doc_id LEFT JOIN vq_norm ON vq_norm.query_id = r.query_id),
top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM scores
  QUALIFY rank <= 4),
asked AS (SELECT query_id, coalesce(nullif(regexp_extract(text,
    '(^|{_EDGE})([A-Z][a-zA-Z]+(?:\\s[A-Z][a-zA-Z]+)*)($|{_EDGE})', 2), ''),
    substring(text, 1, 60)) AS entity FROM way WHERE route = 'graph_query'),
{cg._ASKED}
SELECT query_id, 'rag_retrieval' AS route, string_agg('[' || source || ']' || chr(10) || body,
  chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context FROM top GROUP BY query_id
UNION ALL
SELECT query_id, route, CASE WHEN stg.fund_id IS NULL
    THEN 'No data found for fund \'\'' || w.fund_id || '\'\' in year ' || w.year || '.'
    ELSE '{{"fund_id":"' || w.fund_id || '","fund_name":"' || stg.fund_name || '","year":' || w.year
      || ',"coverage_ratio_pct":' || coverage_ratio_pct || '}}' END
FROM way w LEFT JOIN stg ON 'NL_' || stg.fund_id = w.fund_id AND stg.reporting_year + 5 = w.year
WHERE route = 'sql_query'
UNION ALL
SELECT q.query_id, 'graph_query', coalesce(string_agg('- ' || coalesce(f.name, '?') || ' (' || f.type || ') ['
  || f.relationship || ' / ' || f.direction || ']', chr(10) ORDER BY f.rank), '- ? (?) [? / ?]')
FROM asked q LEFT JOIN found f ON f.query_id = q.query_id GROUP BY q.query_id
UNION ALL SELECT query_id, route, 'HUMAN_REVIEW_REQUESTED' FROM way WHERE route = 'human_checkpoint'
""",
    "prompt_assembly": f"""
WITH {STATE_SQL}
SELECT conv_id, 0::BIGINT AS position, 'system' AS role, '{SYSTEM}' AS content FROM state
UNION ALL SELECT conv_id, 1, 'system', 'Retrieved context:' || chr(10) || chr(10) || 'via ' || coalesce(last_route, 'nothing')
  FROM state WHERE NOT requires_human
UNION ALL SELECT conv_id, turn + 2, role, text FROM conversations""",
}

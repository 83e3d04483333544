"""Documents: counts, previews, token budgets, copies and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.catalog.base import place_sql, sentences_sql, table, tokens_sql, words_sql
from marlstone.functions import text as tx
from marlstone.operators import chunking, entities, profile
from marlstone.session import spread, stack


def _docs(spark, sf) -> DataFrame:
    return spread(table(spark, sf, "documents")).select("doc_id", "text")


def category_counts(spark, sf):
    return profile.category_counts(table(spark, sf, "documents"), "lang")


def category_profile(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.groupBy("lang").agg(
        F.min("n_chars").alias("min_chars"), F.max("n_chars").alias("max_chars"),
        F.countDistinct("source").alias("n_sources"), F.sum(tx.word_count("text")).alias("words"))


def order_year_range(spark, sf):
    return profile.value_range(table(spark, sf, "orders").select(F.year("o_orderdate").alias("y")), "y")


def distinct_labels(spark, sf):
    return profile.distinct_counts(table(spark, sf, "documents"), "text", "lang", "source")


def document_preview(spark, sf):
    docs = table(spark, sf, "documents").filter(F.col("text").isNotNull())
    return docs.select(
        "doc_id", tx.snippet("text").alias("snippet"), tx.snippet("text", always=False).alias("short_text"),
        tx.word_count("text").alias("words"), tx.token_estimate("text").alias("tokens"),
        F.length(tx.strip("text")).alias("stripped_length"), tx.has_content("text").alias("has_content"),
        tx.contains_ignore_case("text", F.lit("LICENSE")).alias("mentions_license"),
        tx.chunk_number(F.col("source")).alias("no_number"))


def dedup_passages(spark, sf):
    return profile.first_of_equal(_docs(spark, sf), "text", "doc_id")


def token_budget(spark, sf):
    return profile.token_budget(_docs(spark, sf), "text", 128_000)


def texts_per_window(spark, sf):
    return profile.texts_per_window(_docs(spark, sf), "doc_id", "text", 32_000)


def packed_context(spark, sf):
    return profile.pack_context(table(spark, sf, "documents"), "text", "doc_id", "source")


def fitting_documents(spark, sf):
    docs = table(spark, sf, "documents")
    return profile.fitting_texts(docs.select("doc_id", "source", "n_chars"), F.col("n_chars"), "doc_id",
                                 "source", 8_000).select("source", "doc_id", "running_size")


def chunk_fixed(spark, sf):
    return chunking.chunk_fixed(_docs(spark, sf)).select("doc_id", "chunk_pos", "content")


def chunk_sentence(spark, sf):
    return chunking.chunk_sentence(_docs(spark, sf)).select("doc_id", "chunk_pos", "content")


def chunk_semantic(spark, sf):
    return chunking.chunk_semantic(_docs(spark, sf)).select("doc_id", "chunk_pos", "content")


def chunk_markdown(spark, sf):
    """Every line of a document becomes a section under its own header."""
    docs = _docs(spark, sf).withColumn("text", F.concat(F.lit("## "), F.regexp_replace("text", "\n", "\n## ")))
    return chunking.chunk_markdown(docs).select("doc_id", "chunk_pos", "content")


def chunk_recursive(spark, sf):
    return chunking.chunk_recursive(_docs(spark, sf)).select("doc_id", "chunk_pos", "content")


def parent_child(spark, sf):
    children, _ = chunking.chunk_parent_child(_docs(spark, sf))
    return children.select("doc_id", "parent_id", "child_idx", "content")


# Phrases of the test documents, for a dictionary run that finds something.
LICENCE_PHRASES = {
    "LICENCE": ("Apache License", "GNU General Public License", "General Public License", "MIT License"),
    "TERMS": ("Licensed under", "Released under", "License"),
}


def entity_extract(spark, sf):
    return entities.extract_entities(_docs(spark, sf), phrases=LICENCE_PHRASES, patterns={})


def entity_by_label(spark, sf):
    found = entities.extract_entities(_docs(spark, sf), phrases=LICENCE_PHRASES, patterns={})
    return entities.entity_texts_by_label(found)


def domain_entities(spark, sf):
    """The domain dictionary over all documents and messages, in which frequent short words stand for its phrases."""
    said = table(spark, sf, "conversations").select(
        F.concat_ws("_", F.lit("c"), "conv_id", "turn").alias("doc_id"), "text")
    texts = stack(_docs(spark, sf).select(F.concat(F.lit("d"), "doc_id").alias("doc_id"), "text"), said)
    phrase = F.element_at(F.array(*map(F.lit, DOMAIN_PHRASES)), F.pmod(F.length("doc_id") * 7 + F.length("text"),
                                                                      F.lit(len(DOMAIN_PHRASES))) + 1)
    word = F.transform(F.split("text", " "), lambda w: F.when(w.isin(*SHORT_WORDS), phrase).otherwise(w))
    texts = texts.select("doc_id", F.array_join(word, " ").alias("text"))
    return entities.extract_entities(texts).groupBy("label", "text").agg(F.count("*").alias("mentions"))


#: All phrases of the dictionary and some numbered ratios.
DOMAIN_PHRASES = [p for group in entities.PHRASES.values() for p in group] + ["105 % coverage ratio", "ninety coverage ratio"]
SHORT_WORDS = ("the", "und", "de", "la")

QUERIES = {f.__name__: f for f in (
    category_counts, category_profile, order_year_range, distinct_labels, document_preview, dedup_passages,
    token_budget, texts_per_window, packed_context, fitting_documents, chunk_fixed, chunk_sentence, chunk_semantic,
    chunk_markdown, chunk_recursive, parent_child, entity_extract, entity_by_label, domain_entities)}

_ESTIMATE = f"CAST(ceil(len({words_sql('text')}) / 0.75::DOUBLE) AS BIGINT)"
_HEADER = r"(?m)^#{1,3}\s+.+$"
_PHRASE = "GNU General Public License|Apache License|General Public License|MIT License|Licensed under|Released under|License"
_ENTITIES = f"""
  found AS (
    SELECT doc_id, text AS doc, regexp_extract_all(text, '\\b(?:{_PHRASE})\\b') AS m,
      string_split_regex(text, '\\b(?:{_PHRASE})\\b') AS g
    FROM documents WHERE regexp_matches(text, '\\b(?:{_PHRASE})\\b')),
  spans AS (
    SELECT doc_id, doc, m[i] AS text,
      list_sum(list_transform(g[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found)),
  entity AS (
    SELECT doc_id, text, s::INTEGER AS start_char, (s + length(text))::INTEGER AS end_char,
      CASE WHEN text IN ('Licensed under', 'Released under', 'License') THEN 'TERMS' ELSE 'LICENCE' END AS label,
      doc
    FROM spans)"""

_LABELLED = [(p, label) for label, group in entities.PHRASES.items() for p in group] + [
    (p, "METRIC") for p in DOMAIN_PHRASES[-2:]]
_LONGEST_FIRST = "|".join(sorted(DOMAIN_PHRASES, key=lambda p: (-len(p), p)))
_DOMAIN = f"""
WITH said AS (SELECT 'd' || doc_id AS doc_id, text FROM documents
  UNION ALL SELECT 'c_' || conv_id || '_' || turn, text FROM conversations),
phrases AS (SELECT [{", ".join(f"'{p}'" for p in DOMAIN_PHRASES)}] AS p),
texts AS (SELECT array_to_string(list_transform(string_split(text, ' '), lambda w: CASE WHEN w IN ('the', 'und', 'de', 'la')
  THEN p[(length(doc_id) * 7 + length(text)) % {len(DOMAIN_PHRASES)} + 1] ELSE w END), ' ') AS text FROM said, phrases),
hits AS (SELECT unnest(regexp_extract_all(text, '\\b(?:{_LONGEST_FIRST})\\b')) AS text FROM texts),
labels(text, label) AS (VALUES {", ".join(f"('{p}', '{label}')" for p, label in _LABELLED)})
SELECT label, text, count(*) AS mentions FROM hits JOIN labels USING (text) GROUP BY ALL"""

SQL = {
    "category_counts": "SELECT lang, count(*) AS n FROM documents GROUP BY lang",
    "category_profile": f"""
SELECT lang, min(n_chars) AS min_chars, max(n_chars) AS max_chars, count(DISTINCT source) AS n_sources,
  CAST(sum(len({words_sql('text')})) AS BIGINT) AS words FROM documents GROUP BY lang""",
    "order_year_range": """
SELECT CAST(min(year(o_orderdate)) AS INTEGER) AS min_value, CAST(max(year(o_orderdate)) AS INTEGER) AS max_value
FROM orders""",
    "distinct_labels": """
SELECT count(DISTINCT text) AS n_text, count(DISTINCT lang) AS n_lang, count(DISTINCT source) AS n_source
FROM documents""",
    "document_preview": f"""
SELECT doc_id, substring(text, 1, 120) || '...' AS snippet,
  CASE WHEN length(text) > 120 THEN substring(text, 1, 120) || '...' ELSE text END AS short_text,
  CAST(len({words_sql('text')}) AS INTEGER) AS words, {_ESTIMATE} AS tokens,
  CAST(length(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '')) AS INTEGER) AS stripped_length,
  regexp_matches(text, '\\S') AS has_content, contains(lower(text), 'license') AS mentions_license,
  CAST(NULL AS BIGINT) AS no_number
FROM documents WHERE text IS NOT NULL""",
    "dedup_passages": "SELECT text, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text",
    "token_budget": f"""
SELECT count(*) AS texts, CAST(sum(t) AS BIGINT) AS total_tokens, sum(c)::DOUBLE / sum(t)::DOUBLE AS chars_per_token,
  CAST(floor(127800 / (sum(t)::DOUBLE / count(*))) AS BIGINT) AS texts_per_window, sum(t) < 128000 AS fits
FROM (SELECT {_ESTIMATE} AS t, length(text) AS c FROM documents WHERE text IS NOT NULL)""",
    "texts_per_window": f"""
SELECT doc_id, t AS tokens, CASE WHEN t > 0 THEN CAST(floor(31800::DOUBLE / t) AS BIGINT) END AS fit
FROM (SELECT doc_id, {_ESTIMATE} AS t FROM documents)""",
    "packed_context": """
SELECT source, substring(string_agg(line, chr(10) || chr(10) ORDER BY no), 1, 3000) AS context,
  CAST(length(string_agg(line, chr(10) || chr(10) ORDER BY no)) AS INTEGER) AS full_length
FROM (SELECT source, no, 'Article ' || no || ': ' || text AS line
      FROM (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS no FROM documents)
      WHERE no <= 10 AND text IS NOT NULL)
GROUP BY source""",
    "fitting_documents": """
SELECT source, doc_id, CAST(running AS BIGINT) AS running_size
FROM (SELECT source, doc_id, sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id) AS running
      FROM documents)
WHERE running <= 8000""",
    "chunk_fixed": """
SELECT doc_id, CAST(s // 450 AS INTEGER) AS chunk_pos, substring(text, s + 1, 500) AS content
FROM (SELECT doc_id, text, unnest(range(0, length(text), 450)) AS s FROM documents)
WHERE regexp_matches(substring(text, s + 1, 500), '\\S')""",
    "chunk_sentence": f"""
WITH RECURSIVE s AS (SELECT doc_id, {sentences_sql('text')} AS l FROM documents),
fold AS (
  SELECT doc_id, l, 1 AS i, 0 AS pos, l[1] AS body, length(l[1]) + 1 AS used, FALSE AS flushed,
    CAST(NULL AS VARCHAR) AS done
  FROM s WHERE len(l) > 0
  UNION ALL
  SELECT doc_id, l, i + 1,
    CASE WHEN used + length(coalesce(l[i + 1], '')) > 500 OR i = len(l) THEN pos + 1 ELSE pos END,
    CASE WHEN i = len(l) THEN NULL WHEN used + length(l[i + 1]) > 500 THEN l[i + 1] ELSE body || ' ' || l[i + 1] END,
    CASE WHEN i = len(l) THEN 0 WHEN used + length(l[i + 1]) > 500 THEN length(l[i + 1]) + 1
      ELSE used + length(l[i + 1]) + 1 END,
    i = len(l) OR used + length(l[i + 1]) > 500,
    CASE WHEN i = len(l) OR used + length(l[i + 1]) > 500 THEN body END
  FROM fold WHERE i <= len(l))
SELECT doc_id, CAST(pos - 1 AS INTEGER) AS chunk_pos, done AS content FROM fold WHERE flushed""",
    "chunk_semantic": f"""
WITH s AS (SELECT doc_id, text, {sentences_sql('text')} AS l FROM documents),
sent AS (SELECT doc_id, unnest(l) AS body, unnest(range(1, len(l) + 1)) AS i FROM s WHERE len(l) >= 2),
places AS (
  SELECT doc_id, i, {place_sql('w')} AS p, count(*)::DOUBLE AS c
  FROM (SELECT doc_id, i, unnest({tokens_sql('body')}) AS w FROM sent) GROUP BY ALL),
norm AS (SELECT doc_id, i, sqrt(sum(c * c)) AS n FROM places GROUP BY ALL),
dots AS (SELECT a.doc_id, a.i, sum(a.c * b.c) AS d
  FROM places a JOIN places b ON a.doc_id = b.doc_id AND b.i = a.i - 1 AND a.p = b.p GROUP BY ALL),
breaks AS (
  SELECT t.doc_id, t.i, t.body,
    CASE WHEN t.i > 1 AND coalesce(d.d, 0) / (n1.n * n0.n + 1e-9) < 0.5 THEN 1 ELSE 0 END AS b
  FROM sent t LEFT JOIN dots d ON d.doc_id = t.doc_id AND d.i = t.i
  JOIN norm n1 ON n1.doc_id = t.doc_id AND n1.i = t.i
  LEFT JOIN norm n0 ON n0.doc_id = t.doc_id AND n0.i = t.i - 1),
islands AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY i) AS isl FROM breaks)
SELECT doc_id, CAST(isl AS INTEGER) AS chunk_pos, string_agg(body, ' ' ORDER BY i) AS content
FROM islands GROUP BY doc_id, isl
UNION ALL
SELECT doc_id, 0, text FROM s WHERE len(l) < 2 AND regexp_matches(text, '\\S')""",
    "chunk_markdown": f"""
WITH md AS (
  SELECT doc_id, '## ' || replace(text, chr(10), chr(10) || '## ') AS t FROM documents),
cut AS (SELECT doc_id, regexp_extract_all(t, '{_HEADER}') AS h, string_split_regex(t, '{_HEADER}') AS g FROM md),
sec AS (SELECT doc_id, i, h[i + 1] || g[i + 2] AS body FROM (SELECT *, unnest(range(0, len(h))) AS i FROM cut))
SELECT doc_id, CAST(i AS INTEGER) AS chunk_pos,
  regexp_replace(regexp_replace(body, '^\\s+', ''), '\\s+$', '') AS content
FROM sec WHERE regexp_matches(body, '\\S')""",
    "entity_extract": f"""
WITH {_ENTITIES},
sent AS (
  SELECT doc_id, unnest(l) AS body, unnest(list_transform(range(1, len(l) + 1), lambda i:
      coalesce(list_sum(list_transform(l[1:i-1], lambda x: length(x) + 1)), 0))) AS b
  FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\\s', '\\1' || chr(1), 'g'), chr(1)) AS l
        FROM documents))
SELECT e.doc_id, e.text, e.label, e.start_char, e.end_char,
  regexp_replace(regexp_replace(s.body, '^\\s+', ''), '\\s+$', '') AS sentence
FROM entity e JOIN sent s ON s.doc_id = e.doc_id AND e.start_char >= s.b AND e.start_char < s.b + length(s.body)""",
    "entity_by_label": f"""
WITH {_ENTITIES}
SELECT doc_id, label, text, min(start_char) AS first_at, count(*) AS mentions FROM entity GROUP BY ALL""",
    "domain_entities": _DOMAIN,
}

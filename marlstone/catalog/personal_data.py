"""Personal data in documents, messages and a derived account column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.catalog.base import table
from marlstone.functions import text as tx
from marlstone.operators import personal_data as pd_
from marlstone.session import spread, stack


def _accounts(spark, sf) -> DataFrame:
    """An account number per customer, with check digits that are right for some of them."""
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.alias("row_pos"), F.concat(
            F.lit("NL"), F.lpad((key % 100).cast("string"), 2, "0"), F.lit("BANK"),
            F.lpad(key.cast("string"), 10, "0")).alias("Counterparty_IBAN"),
        F.concat(F.lit("pay to "), "c_name").alias("note"))


def _cells(spark, sf) -> DataFrame:
    docs = spread(table(spark, sf, "documents"))
    said = table(spark, sf, "conversations").withColumn("pos", F.col("conv_id") * 100000 + F.col("turn"))
    return stack(
        pd_.table_cells(docs, ["text", "source", "lang"], F.lit("documents"), F.col("doc_id")),
        pd_.table_cells(said, ["text", "role"], F.lit("conversations"), F.col("pos")),
        pd_.table_cells(_accounts(spark, sf), ["Counterparty_IBAN", "note"], F.lit("accounts"), F.col("row_pos")),
    )


def _findings(spark, sf) -> DataFrame:
    return pd_.column_findings(_cells(spark, sf))


def pii_findings(spark, sf):
    return _findings(spark, sf).withColumn("example_values", F.array_join("example_values", "\n~~\n"))


def pii_hits(spark, sf):
    hits = pd_.cell_hits(_cells(spark, sf))
    return hits.select("file_path", "column_name", "row_pos", "entity_type", F.md5("example").alias("example_md5"))


def pii_redact(spark, sf):
    """All documents with personal data, redacted."""
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    found = docs.filter(pd_.any_match(F.col("text"), pd_.DETECTORS))
    return found.select("doc_id", pd_.redact(F.col("text")).alias("redacted"))


def iban_check(spark, sf):
    return _accounts(spark, sf).select("row_pos", pd_.iban_is_valid(F.col("Counterparty_IBAN")).alias("valid"))


def pii_names(spark, sf):
    """A listed-names detector over messages and account notes."""
    names = pd_.gazetteer("PERSON", ["Customer", "Étion dans", "Étion", "der einschtzch"])
    docs = spread(table(spark, sf, "documents"))
    cells = stack(
        pd_.table_cells(docs, ["text"], F.lit("documents"), F.col("doc_id")),
        pd_.table_cells(table(spark, sf, "conversations"), ["text"], F.lit("conversations"), F.col("conv_id")))
    return pd_.column_counts(cells, (names,)).select("file_path", "entity_type", "row_count_with_pii", "allowed")


def _text_findings(spark, sf) -> DataFrame:
    docs = spread(table(spark, sf, "documents")).select(F.col("doc_id").alias("file_path"), "text")
    return pd_.text_findings(docs)


def pii_text_findings(spark, sf):
    return _text_findings(spark, sf).withColumn("example_values", F.array_join("example_values", "\n~~\n"))


def pii_spans(spark, sf):
    """Every e-mail address with its offsets."""
    docs = spread(table(spark, sf, "documents")).filter(F.col("text").rlike(pd_.EMAIL.pattern))
    found = docs.select("doc_id", F.explode(tx.spans("text", pd_.EMAIL.pattern)).alias("s"))
    return found.select("doc_id", F.col("s.value").alias("value"), F.col("s.start").alias("start_char"),
                        F.col("s.end").alias("end_char"))


def pii_gate(spark, sf):
    return pd_.scan_summary(pd_.column_counts(_cells(spark, sf)))


def pii_per_file(spark, sf):
    return pd_.findings_per_file(pd_.column_counts(_cells(spark, sf)))


def pii_status(spark, sf):
    return pd_.status_table(pd_.column_counts(_cells(spark, sf)))


QUERIES = {f.__name__: f for f in (
    pii_findings, pii_hits, pii_redact, iban_check, pii_names, pii_text_findings, pii_spans, pii_gate, pii_per_file,
    pii_status)}

_EMAIL = pd_.EMAIL.pattern
_PHONE = pd_.PHONE.pattern
_DATE = pd_.DATE_TIME.pattern
_IBAN = r"NL\d{2}BANK\d{10}"
_VALID = "(('11102320' || lpad(c_custkey::VARCHAR, 10, '0') || '2321' || lpad((c_custkey % 100)::VARCHAR, 2, '0'))::HUGEINT % 97 = 1)"
_STRIP = lambda c: f"regexp_replace(regexp_replace({c}, '^\\s+', ''), '\\s+$', '')"
_HITS = f"""
cells AS (
  SELECT 'documents' AS file_path, 'text' AS column_name, doc_id AS row_pos, {_STRIP('text')} AS v, TRUE AS ok FROM documents
  UNION ALL SELECT 'documents', 'source', doc_id, source, TRUE FROM documents
  UNION ALL SELECT 'documents', 'lang', doc_id, lang, TRUE FROM documents
  UNION ALL SELECT 'conversations', 'text', conv_id * 100000 + turn, {_STRIP('text')}, TRUE FROM conversations
  UNION ALL SELECT 'conversations', 'role', conv_id * 100000 + turn, role, TRUE FROM conversations
  UNION ALL SELECT 'accounts', 'note', c_custkey, 'pay to ' || c_name, TRUE FROM customer
  UNION ALL SELECT 'accounts', 'Counterparty_IBAN', c_custkey,
    'NL' || lpad((c_custkey % 100)::VARCHAR, 2, '0') || 'BANK' || lpad(c_custkey::VARCHAR, 10, '0'), {_VALID} FROM customer),
hits AS (
  SELECT file_path, column_name, row_pos, 'EMAIL_ADDRESS' AS entity_type, 1.0::DOUBLE AS conf,
    regexp_replace(v, '{_EMAIL}', '<EMAIL_ADDRESS>', 'g') AS example FROM cells WHERE regexp_matches(v, '{_EMAIL}')
  UNION ALL SELECT file_path, column_name, row_pos, 'PHONE_NUMBER', 0.75,
    regexp_replace(v, '{_PHONE}', '<PHONE_NUMBER>', 'g') FROM cells WHERE regexp_matches(v, '{_PHONE}')
  UNION ALL SELECT file_path, column_name, row_pos, 'DATE_TIME', 0.85,
    regexp_replace(v, '{_DATE}', '<DATE_TIME>', 'g') FROM cells WHERE regexp_matches(v, '{_DATE}')
  UNION ALL SELECT file_path, column_name, row_pos, 'IBAN_CODE', 1.0, '<IBAN_CODE>'
    FROM cells WHERE ok AND regexp_matches(v, '{_IBAN}')),
findings AS (
  SELECT file_path, 'csv' AS file_type, column_name, entity_type, count(*) AS row_count_with_pii,
    array_to_string((list(example ORDER BY row_pos, example))[1:3], chr(10) || '~~' || chr(10)) AS example_values,
    lower(column_name) IN ('counterparty_email', 'counterparty_iban', 'analyst_email') AS allowed,
    min(conf) AS confidence_min, max(conf) AS confidence_max
  FROM hits GROUP BY file_path, column_name, entity_type)"""


def _spans_cte(name: str, pattern: str) -> str:
    return f"""
{name}_f AS (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS h, string_split_regex(text, '{pattern}') AS g
  FROM documents WHERE regexp_matches(text, '{pattern}')),
{name} AS (SELECT doc_id, text, i, h[i] AS value,
    list_sum(list_transform(g[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(h[1:i-1], lambda x: length(x))), 0) AS s
  FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM {name}_f))"""


_TEXT_KINDS = {"EMAIL_ADDRESS": (_EMAIL, 1.0), "PHONE_NUMBER": (_PHONE, 0.75), "DATE_TIME": (_DATE, 0.85)}
_TEXT_FINDINGS = "WITH " + ", ".join(_spans_cte(f"k{i}", p) for i, (p, _) in enumerate(_TEXT_KINDS.values())) + (
    ", spans AS (" + " UNION ALL ".join(
        f"SELECT '{e}' AS entity_type, {c}::DOUBLE AS conf, * FROM k{i}"
        for i, (e, (_, c)) in enumerate(_TEXT_KINDS.items())) + ")") + """
SELECT doc_id AS file_path, 'txt' AS file_type, CAST(NULL AS VARCHAR) AS column_name, entity_type,
  count(*) AS row_count_with_pii,
  string_agg(CASE WHEN i <= 3 THEN substring(text, (greatest(s - 15, 0) + 1)::BIGINT, (s - greatest(s - 15, 0))::BIGINT)
    || '<' || entity_type || '>' || substring(text, (s + length(value) + 1)::BIGINT, 15) END,
    chr(10) || '~~' || chr(10) ORDER BY i) AS example_values,
  FALSE AS allowed, min(conf) AS confidence_min, max(conf) AS confidence_max
FROM spans GROUP BY doc_id, entity_type"""

SQL = {
    "pii_findings": f"WITH {_HITS} SELECT * FROM findings",
    "pii_hits": f"WITH {_HITS} SELECT file_path, column_name, row_pos, entity_type, md5(example) AS example_md5 FROM hits",
    "pii_redact": f"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '{_EMAIL}', '<EMAIL_ADDRESS>', 'g'),
  '{_PHONE}', '<PHONE_NUMBER>', 'g'), '{_DATE}', '<DATE_TIME>', 'g') AS redacted
FROM documents WHERE regexp_matches(text, '{_EMAIL}') OR regexp_matches(text, '{_PHONE}') OR regexp_matches(text, '{_DATE}')""",
    "iban_check": f"SELECT c_custkey AS row_pos, {_VALID} AS valid FROM customer",
    "pii_names": """
WITH cells AS (SELECT 'documents' AS file_path, text AS v FROM documents UNION ALL SELECT 'conversations', text FROM conversations)
SELECT file_path, 'PERSON' AS entity_type, count(*) AS row_count_with_pii, FALSE AS allowed FROM cells
WHERE regexp_matches(v, '(^|[^\\p{L}\\p{N}\\p{M}_])(Customer|Étion dans|Étion|der einschtzch)($|[^\\p{L}\\p{N}\\p{M}_])') GROUP BY file_path""",
    "pii_text_findings": _TEXT_FINDINGS,
    "pii_spans": f"""
WITH {_spans_cte('k', _EMAIL)}
SELECT doc_id, value, s::INTEGER AS start_char, (s + length(value))::INTEGER AS end_char FROM k""",
    "pii_gate": f"""
WITH {_HITS} SELECT count(*) AS total_findings, coalesce(bool_or(NOT allowed), FALSE) AS unexpected_pii_found FROM findings""",
    "pii_per_file": f"""
WITH {_HITS} SELECT file_path, count(*) AS findings, count(*) FILTER (NOT allowed) AS unexpected FROM findings GROUP BY file_path""",
    "pii_status": f"""
WITH {_HITS} SELECT file_path, column_name, entity_type, row_count_with_pii,
  CASE WHEN allowed THEN 'ALLOWED' ELSE 'UNEXPECTED' END AS status FROM findings""",
}

"""Customers as funds, orders as transactions, documents as articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.catalog.base import table, words_sql
from marlstone.functions import keys
from marlstone.plans import medallion as m
from marlstone.sources import seeds


def raw_funds(spark, sf) -> DataFrame:
    """Yearly fund rows; the coverage ratio is a year's order total against the fund's mean year."""
    yearly = table(spark, sf, "orders").groupBy(
        F.col("o_custkey").alias("fund_id"), F.year("o_orderdate").alias("reporting_year")).agg(
        F.sum("o_totalprice").alias("aum_eur"))
    ratio = 100 * F.col("aum_eur") / F.avg("aum_eur").over(Window.partitionBy("fund_id"))
    nations = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("regulatory_regime"))
    funds = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("fund_id"), F.col("c_name").alias("fund_name"), "country", "regulatory_regime")
    return yearly.withColumn("coverage_ratio_pct", F.round(ratio, 6)).join(funds, "fund_id").select(
        "fund_id", "fund_name", "reporting_year", "coverage_ratio_pct", F.round("aum_eur", 2).alias("aum_eur"),
        "country", "regulatory_regime")


def raw_transactions(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("fund_id"),
        F.col("o_orderdate").alias("transaction_date"), F.col("o_totalprice").alias("amount"),
        F.concat(F.lit("c"), "o_custkey", F.lit("@mail.example.com")).alias("counterparty_email"),
        F.concat(F.lit("NL"), "o_orderkey").alias("counterparty_iban"))


def raw_articles(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("abstract"), F.col("lang").alias("category"), "source")


def stg_funds(spark, sf):
    return m.stg_pension_funds(raw_funds(spark, sf))


def stg_transactions(spark, sf):
    return m.stg_transactions(raw_transactions(spark, sf))


def stg_articles(spark, sf):
    return m.stg_articles(raw_articles(spark, sf)).drop("abstract")


def fund_year_metrics(spark, sf):
    out = m.int_fund_yearly_metrics(stg_funds(spark, sf), stg_transactions(spark, sf))
    return out.select("fund_id", "reporting_year", "fund_name", "coverage_status", "n_transactions",
                      *[F.round(c, 2).alias(c) for c in ("total_amount", "max_amount")],
                      F.round("avg_amount", 4).alias("avg_amount"))


def _dim(spark, sf) -> DataFrame:
    return m.dim_funds(stg_funds(spark, sf))


def dim_funds(spark, sf):
    return _dim(spark, sf)


def transaction_enriched(spark, sf):
    return m.int_transaction_enriched(stg_transactions(spark, sf), _dim(spark, sf))


def fact_transactions(spark, sf):
    return m.fact_transactions(transaction_enriched(spark, sf))


def rag_corpus(spark, sf):
    return m.mart_rag_corpus(m.stg_articles(raw_articles(spark, sf))).drop("abstract")


def coverage_classes(spark, sf):
    return stg_funds(spark, sf).groupBy("coverage_status").agg(F.count("*").alias("n"))


def surrogate_keys(spark, sf):
    """Keys over a text, an integer and a missing field."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return docs.select("doc_id", keys.surrogate_key("lang", "doc_id", "quality").alias("k"))


def fund_lookup(spark, sf):
    """Every event asks for its user's figures in a year derived from the event."""
    asked = table(spark, sf, "events").select(
        F.col("user_id").alias("fund_id"), (F.lit(1992) + F.col("event_id") % 12).cast("int").alias("year"))
    return m.fund_lookup(asked, _dim(spark, sf), stg_funds(spark, sf))


def row_tests(spark, sf):
    return m.check_models({"stg_pension_funds": stg_funds(spark, sf),
                           "stg_transactions": stg_transactions(spark, sf)}, F.lit("1999-06-30").cast("date"))


def future_transactions(spark, sf):
    return m.transactions_in_future(stg_transactions(spark, sf), F.lit("1999-12-01").cast("date"))


def asset_class_totals(spark, sf):
    """Parts dealt to the asset classes, with the capital they tie up."""
    codes = F.array(*[F.lit(c[0]) for c in seeds.ASSET_CLASSES], F.lit("NONE"))
    parts = table(spark, sf, "part").withColumn("asset_class_code", F.get(codes, F.col("p_size") % 8))
    joined = seeds.with_asset_class(parts)
    return joined.groupBy("asset_class_code", "asset_class_name", "is_alternative", "liquidity_tier").agg(
        F.count("*").alias("parts"),
        F.round(F.sum(F.col("p_retailprice") * F.col("solvency_capital_factor")), 2).alias("capital"))


def country_labels(spark, sf):
    """A small fixed table by upper-cased key, with a default for unknown keys."""
    table_ = {"en": "English", "de": "German", "fr": "French"}
    docs = table(spark, sf, "documents")
    label = keys.lookup(F.col("lang"), table_, F.concat(F.lit("No data for '"), "lang", F.lit("'.")))
    return docs.groupBy(label.alias("label")).agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (
    stg_funds, stg_transactions, stg_articles, fund_year_metrics, dim_funds, transaction_enriched, fact_transactions,
    rag_corpus, coverage_classes, surrogate_keys, fund_lookup, row_tests, future_transactions, asset_class_totals,
    country_labels)}

_CLASS = """CASE WHEN coverage_ratio_pct < 100 THEN 'underfunded' WHEN coverage_ratio_pct < 110 THEN 'at_risk'
  WHEN coverage_ratio_pct < 125 THEN 'healthy' ELSE 'well_funded' END"""
_FUNDS = f"""
yearly AS (SELECT o_custkey AS fund_id, CAST(year(o_orderdate) AS INTEGER) AS reporting_year, sum(o_totalprice) AS aum
  FROM orders GROUP BY ALL),
funds AS (SELECT fund_id, c_name AS fund_name, reporting_year,
    round(100 * aum / avg(aum) OVER (PARTITION BY fund_id), 6) AS coverage_ratio_pct, round(aum, 2) AS aum_eur,
    n_name AS country, r_name AS regulatory_regime
  FROM yearly JOIN customer ON c_custkey = fund_id JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey),
stg AS (SELECT *, {_CLASS} AS coverage_status FROM funds),
dim AS (SELECT *, md5(fund_id || '-' || reporting_year) AS fund_key FROM stg
  QUALIFY row_number() OVER (PARTITION BY fund_id ORDER BY reporting_year DESC) = 1)"""
_TX = """
tx AS (SELECT o_orderkey AS transaction_id, o_custkey AS fund_id, CAST(o_orderdate AS DATE) AS transaction_date,
  o_totalprice AS amount, md5('c' || o_custkey || '@mail.example.com') AS counterparty_email_hash,
  md5('NL' || o_orderkey) AS counterparty_iban_hash FROM orders)"""
_ENRICHED = f"""
WITH {_FUNDS}, {_TX},
enriched AS (SELECT tx.*, fund_name, country, regulatory_regime FROM tx LEFT JOIN dim ON dim.fund_id = tx.fund_id)"""
_WORDS = f"len({words_sql('text')})"

SQL = {
    "stg_funds": f"WITH {_FUNDS} SELECT * FROM stg",
    "stg_transactions": f"WITH {_TX} SELECT * FROM tx",
    "stg_articles": f"""
SELECT doc_id AS id, lang AS category, source, {_WORDS} >= 20 AS rag_eligible
FROM documents WHERE regexp_matches(text, '\\S')""",
    "fund_year_metrics": f"""
WITH {_FUNDS}, {_TX},
agg AS (SELECT fund_id, year(transaction_date) AS y, count(*) AS n, sum(amount) AS s, avg(amount) AS a, max(amount) AS x
  FROM tx GROUP BY ALL)
SELECT stg.fund_id, reporting_year, fund_name, coverage_status, coalesce(n, 0) AS n_transactions,
  round(s, 2) AS total_amount, round(x, 2) AS max_amount, round(a, 4) AS avg_amount
FROM stg LEFT JOIN agg ON agg.fund_id = stg.fund_id AND y = reporting_year""",
    "dim_funds": f"WITH {_FUNDS} SELECT * FROM dim",
    "transaction_enriched": f"{_ENRICHED} SELECT * FROM enriched",
    "fact_transactions": f"""
{_ENRICHED}
SELECT transaction_id, fund_id, transaction_date, amount, fund_name, country, regulatory_regime,
  md5(transaction_id || '-' || fund_id) AS transaction_key FROM enriched""",
    "rag_corpus": f"""
SELECT doc_id AS id, lang AS category, source, TRUE AS rag_eligible,
  round(least({_WORDS} / 200.0::DOUBLE, 1.0), 6) AS quality_score
FROM documents WHERE regexp_matches(text, '\\S') AND {_WORDS} >= 20""",
    "coverage_classes": f"WITH {_FUNDS} SELECT coverage_status, count(*) AS n FROM stg GROUP BY coverage_status",
    "surrogate_keys": """
SELECT d.doc_id, md5(lang || '-' || d.doc_id || '-' || coalesce(quality::VARCHAR, '_dbt_utils_surrogate_key_null_')) AS k
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "fund_lookup": f"""
WITH {_FUNDS},
asked AS (SELECT DISTINCT user_id AS fund_id, CAST(1992 + event_id % 12 AS INTEGER) AS year FROM events),
found AS (SELECT stg.fund_id, stg.reporting_year, dim.fund_name, stg.coverage_ratio_pct
  FROM stg JOIN dim ON dim.fund_id = stg.fund_id)
SELECT a.fund_id, a.year, fund_name, coverage_ratio_pct,
  CASE WHEN fund_name IS NULL THEN 'No data found for fund ''' || a.fund_id || ''' in year ' || a.year || '.' END AS error
FROM asked a LEFT JOIN found f ON f.fund_id = a.fund_id AND f.reporting_year = a.year""",
    "row_tests": f"""
WITH {_FUNDS}, {_TX},
t AS (SELECT 'coverage_ratio_positive' AS test, count(*) FILTER (coverage_ratio_pct <= 0) AS failures FROM stg
  UNION ALL
  SELECT 'no_future_transactions', count(*) FILTER (transaction_date > DATE '1999-06-30') FROM tx)
SELECT test, failures, failures = 0 AS passed FROM t""",
    "future_transactions": f"""
WITH {_TX} SELECT transaction_id, fund_id, transaction_date FROM tx WHERE transaction_date > DATE '1999-12-01'""",
    "asset_class_totals": """
WITH seed(asset_class_code, asset_class_name, is_alternative, liquidity_tier, f) AS (VALUES
  ('EQ', 'Equity', FALSE, 1, 0.39::DOUBLE), ('FI', 'Fixed Income', FALSE, 1, 0.12), ('RE', 'Real Estate', TRUE, 3, 0.25),
  ('PE', 'Private Equity', TRUE, 4, 0.49), ('HF', 'Hedge Funds', TRUE, 3, 0.32), ('INFRA', 'Infrastructure', TRUE, 4, 0.30),
  ('CASH', 'Cash & Equivalents', FALSE, 1, 0.0)),
p AS (SELECT *, (['EQ', 'FI', 'RE', 'PE', 'HF', 'INFRA', 'CASH', 'NONE'])[p_size % 8 + 1] AS code FROM part)
SELECT code AS asset_class_code, asset_class_name, is_alternative, liquidity_tier, count(*) AS parts,
  round(sum(p_retailprice * f), 2) AS capital
FROM p LEFT JOIN seed ON asset_class_code = code GROUP BY ALL""",
    "country_labels": """
SELECT CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French'
  ELSE 'No data for ''' || lang || '''.' END AS label, count(*) AS n FROM documents GROUP BY label""",
}

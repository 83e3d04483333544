"""Staging, intermediate and mart models, and their row tests.

The rules that are described but not written down anywhere (article filter,
quality score, regime) are parameters with the defaults below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions import keys
from marlstone.functions import text as tx
from marlstone.sources.tables import materialise
from marlstone.session import stack

# Default of the article filter: words from which an article is long enough.
MIN_WORDS = 20


def stg_pension_funds(raw: DataFrame, null_class: str | None = None) -> DataFrame:
    """Typed yearly fund rows with their coverage class."""
    typed = raw.withColumn("reporting_year", F.col("reporting_year").cast("int")).withColumn(
        "coverage_ratio_pct", F.col("coverage_ratio_pct").cast("double")).withColumn(
        "fund_name", tx.strip("fund_name"))
    return typed.withColumn("coverage_status", keys.ratio_class(F.col("coverage_ratio_pct"), null_class))


def stg_transactions(raw: DataFrame, personal: tuple[str, ...] = ("counterparty_email", "counterparty_iban"),
                     salt: str = "") -> DataFrame:
    """Typed transactions; personal columns become ``<name>_hash`` and the raw values go."""
    typed = raw.withColumn("transaction_date", F.col("transaction_date").cast("date")).withColumn(
        "amount", F.col("amount").cast("double"))
    for c in (c for c in personal if c in raw.columns):
        typed = typed.withColumn(f"{c}_hash", keys.pseudonym(F.col(c), salt)).drop(c)
    return typed


def stg_articles(raw: DataFrame, keep: Column | None = None, good: Column | None = None,
                 text: str = "abstract") -> DataFrame:
    """Articles that pass ``keep`` (has text) with ``rag_eligible`` from ``good`` (long enough)."""
    keep = tx.has_content(text) if keep is None else keep
    good = (tx.word_count(text) >= MIN_WORDS) if good is None else good
    return raw.filter(keep).withColumn("rag_eligible", F.coalesce(good, F.lit(False)))


def yearly_transactions(transactions: DataFrame) -> DataFrame:
    """Count, sum, mean and largest amount per fund and year, combined in the tasks before the shuffle."""
    return transactions.groupBy("fund_id", F.year("transaction_date").alias("reporting_year")).agg(
        F.count("*").alias("n_transactions"), F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"), F.max("amount").alias("max_amount"))


def int_fund_yearly_metrics(funds: DataFrame, transactions: DataFrame) -> DataFrame:
    """Yearly fund rows with that year's transaction figures (none: zero count, null amounts)."""
    joined = funds.join(yearly_transactions(transactions), ["fund_id", "reporting_year"], "left")
    return joined.withColumn("n_transactions", F.coalesce("n_transactions", F.lit(0)))


def int_transaction_enriched(transactions: DataFrame, fund_info: DataFrame) -> DataFrame:
    """Transactions with fund name, country and regime; ``fund_info`` has one row per fund.

    Spark sends ``fund_info`` to every task when it is small enough and splits
    over-full join partitions of a frequent fund when it is not.
    """
    return transactions.join(fund_info.select("fund_id", "fund_name", "country", "regulatory_regime"),
                             "fund_id", "left")


def dim_funds(funds: DataFrame) -> DataFrame:
    """One row per fund at its latest reporting year, with a surrogate key."""
    rest = [c for c in funds.columns if c not in ("fund_id", "reporting_year")]
    latest = funds.groupBy("fund_id").agg(F.max(F.struct("reporting_year", *rest)).alias("r"))
    return latest.select("fund_id", "r.*").withColumn("fund_key", keys.surrogate_key("fund_id", "reporting_year"))


def fact_transactions(enriched: DataFrame, drop: tuple[str, ...] = (
        "counterparty_email", "counterparty_iban", "analyst_email",
        "counterparty_email_hash", "counterparty_iban_hash")) -> DataFrame:
    """Enriched transactions without personal columns, with a surrogate key."""
    return enriched.drop(*drop).withColumn("transaction_key", keys.surrogate_key("transaction_id", "fund_id"))


def mart_rag_corpus(articles: DataFrame, score: Column | None = None, text: str = "abstract") -> DataFrame:
    """Eligible articles with a quality score; the default is length against 200 words, at most 1."""
    score = F.least(tx.word_count(text) / 200.0, F.lit(1.0)) if score is None else score
    return articles.filter("rag_eligible").withColumn("quality_score", F.round(score, 6))


def coverage_not_positive(funds: DataFrame) -> DataFrame:
    """Failing rows: coverage ratio of zero or less."""
    return funds.filter(F.col("coverage_ratio_pct") <= 0).select(
        "fund_id", "fund_name", "reporting_year", "coverage_ratio_pct")


def transactions_in_future(transactions: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Failing rows: transactions after ``as_of`` (today)."""
    return transactions.filter(F.col("transaction_date") > (F.current_date() if as_of is None else as_of)).select(
        "transaction_id", "fund_id", "transaction_date")


def run_row_tests(tests: dict[str, DataFrame]) -> DataFrame:
    """``(test, failures, passed)`` for tests that are queries for failing rows."""
    counts = [df.agg(F.count("*").alias("failures")).select(F.lit(name).alias("test"), "failures")
              for name, df in tests.items()]
    return stack(*counts).withColumn("passed", F.col("failures") == 0)


def fund_lookup(requests: DataFrame, funds: DataFrame, metrics: DataFrame,
                columns: tuple[str, ...] = ("coverage_ratio_pct",)) -> DataFrame:
    """Answer ``(fund_id, year)`` requests from the fund dimension and the yearly metrics.

    Requests without a match get an ``error`` text, the others null. Repeated
    requests are looked up once.
    """
    asked = requests.select("fund_id", "year").distinct()
    per_year = metrics.select("fund_id", F.col("reporting_year").alias("year"), *columns)
    one = per_year.join(asked, ["fund_id", "year"], "left_semi").groupBy("fund_id", "year").agg(
        F.max(F.struct(*columns)).alias("m"))
    found = one.join(funds.select("fund_id", "fund_name"), "fund_id").select("fund_id", "year", "fund_name", "m.*")
    error = F.when(F.col("fund_name").isNull(), F.format_string(
        "No data found for fund '%s' in year %d.", F.col("fund_id").cast("string"), F.col("year")))
    return asked.join(found, ["fund_id", "year"], "left").select(
        "fund_id", "year", "fund_name", *columns, error.alias("error"))


# The models in build order with their layer; each takes the models built so far.
MODELS: list[tuple[str, str, Callable[[dict[str, DataFrame]], DataFrame]]] = [
    ("stg_pension_funds", "staging", lambda m: stg_pension_funds(m["pension_funds"])),
    ("stg_transactions", "staging", lambda m: stg_transactions(m["transactions"])),
    ("stg_articles", "staging", lambda m: stg_articles(m["articles"])),
    ("int_fund_yearly_metrics", "intermediate",
     lambda m: int_fund_yearly_metrics(m["stg_pension_funds"], m["stg_transactions"])),
    ("dim_funds", "marts", lambda m: dim_funds(m["int_fund_yearly_metrics"])),
    ("int_transaction_enriched", "intermediate",
     lambda m: int_transaction_enriched(m["stg_transactions"], m["dim_funds"])),
    ("fact_transactions", "marts", lambda m: fact_transactions(m["int_transaction_enriched"])),
    ("mart_rag_corpus", "marts", lambda m: mart_rag_corpus(m["stg_articles"])),
]


def run_models(raw: dict[str, DataFrame], select: str | None = None) -> dict[str, DataFrame]:
    """Build all models, or those of one layer (or one name) with what they stand on.

    ``raw`` has ``pension_funds, transactions, articles``. Models outside the
    selection are used as plain queries and not stored.
    """
    known = {layer for _, layer, _ in MODELS} | {name for name, _, _ in MODELS}
    if select is not None and select not in known:
        raise ValueError(f"Unknown selection '{select}'. Choose from: {sorted(known)}")
    built = dict(raw)
    for name, layer, model in MODELS:
        df = model(built)
        chosen = select is None or select in (name, layer)
        built[name] = materialise(df, name, layer) if chosen else df
    return {name: built[name] for name, layer, _ in MODELS if select is None or select in (name, layer)}


def check_models(built: dict[str, DataFrame], as_of: Column | None = None) -> DataFrame:
    """The row tests of the models."""
    return run_row_tests({
        "coverage_ratio_positive": coverage_not_positive(built["stg_pension_funds"]),
        "no_future_transactions": transactions_in_future(built["stg_transactions"], as_of),
    })

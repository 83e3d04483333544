"""Scoring rankings and answers against a golden set.

``ranked`` has ``query_id, method, rank, content``; ``golden`` has one row per
question and context: ``query_id, context``. ``methods`` names the rankings, so
that one without a single hit is reported too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators.embedding import Embedder
from marlstone.operators.patterns import contained
from marlstone.operators.quantiles import exact_percentiles
from marlstone.functions import vector as vx
from marlstone.session import stack

# Scores from which a metric passes.
STRONG_THRESHOLDS = {
    "faithfulness": 0.80,
    "answer_relevancy": 0.80,
    "context_precision": 0.70,
    "context_recall": 0.70,
}


def is_relevant(content: Column, context: Column, match: str = "prefix80") -> Column:
    """``prefix80``: the first 80 characters of one text occur in the other; ``exact``: equal texts."""
    if match == "exact":
        return content == context
    if match != "prefix80":
        raise ValueError("match must be 'prefix80' or 'exact'")
    return F.contains(content, F.substring(context, 1, 80)) | F.contains(context, F.substring(content, 1, 80))


def holders(corpus: DataFrame, golden: DataFrame) -> DataFrame:
    """``(query_id, chunk_id)``: every pair of a context and a document that ``is_relevant`` calls relevant.

    Null texts hold nothing, an empty one is held by every text. Documents are read
    where they lie, whatever their length (see ``patterns.contained``).
    """
    docs = corpus.select("chunk_id", "content").filter(F.col("content").isNotNull())
    asked = golden.select("query_id", "context").filter(F.col("context").isNotNull())
    named = asked.select("query_id", F.substring("context", 1, 80).alias("_head"))
    held = contained(docs, ["chunk_id"], "content", named, "_head")
    within = docs.select("chunk_id", F.substring("content", 1, 80).alias("_start"))
    inside = contained(asked, ["query_id"], "context", within, "_start")
    empty = stack(named.filter("_head = ''").crossJoin(docs.select("chunk_id")).select("query_id", "chunk_id"),
                  within.filter("_start = ''").crossJoin(named.select("query_id")).select("query_id", "chunk_id"))
    return stack(held.join(named, "_head").select("query_id", "chunk_id"),
                 inside.join(within, "_start").select("query_id", "chunk_id"), empty).distinct()


def golden_pairs(golden: DataFrame, context_of: str = "contexts") -> DataFrame:
    """One row per question and context of a golden set with an array of contexts."""
    kept = [c for c in golden.columns if c != context_of]
    return golden.select(*kept, F.posexplode(context_of).alias("context_pos", "context"))


def in_corpus(pairs: DataFrame, corpus: DataFrame, content: str = "content") -> DataFrame:
    """Only pairs whose context is itself a passage of the corpus."""
    return pairs.join(corpus.select(F.col(content).alias("context")), "context", "left_semi")


def recall_per_pair(ranked: DataFrame, golden: DataFrame, methods: list[str], k: int = 5,
                    match: str = "prefix80") -> DataFrame:
    """``(method, query_id, context, hit)`` for every method and pair; hit is 0 or 1."""
    top = ranked.filter(F.col("rank") <= k)
    pairs = golden.select("query_id", "context").distinct()
    hits = top.join(pairs, "query_id").filter(is_relevant(F.col("content"), F.col("context"), match)).select(
        "method", "query_id", "context").distinct().withColumn("hit", F.lit(1))
    return pairs.withColumn("method", F.explode(F.array(*map(F.lit, methods)))).join(
        hits, ["method", "query_id", "context"], "left").select(
        "method", "query_id", "context", F.coalesce("hit", F.lit(0)).alias("hit"))


def recall_at_k(ranked: DataFrame, golden: DataFrame, methods: list[str], k: int = 5,
                match: str = "prefix80") -> DataFrame:
    """``(method, recall, pairs)``: share of pairs with a relevant passage in the first ``k``."""
    return recall_per_pair(ranked, golden, methods, k, match).groupBy("method").agg(
        F.avg("hit").alias("recall"), F.count("*").alias("pairs"))


def reciprocal_ranks(ranked: DataFrame, golden: DataFrame, methods: list[str], k: int = 5,
                     match: str = "prefix80") -> DataFrame:
    """``(method, query_id, rr)``: 1 / rank of the first relevant passage, 0 without one."""
    top = ranked.filter(F.col("rank") <= k)
    best = top.join(golden.select("query_id", "context"), "query_id").filter(
        is_relevant(F.col("content"), F.col("context"), match)).groupBy("method", "query_id").agg(
        F.min("rank").alias("best"))
    asked = golden.select("query_id").distinct().withColumn("method", F.explode(F.array(*map(F.lit, methods))))
    return asked.join(best, ["method", "query_id"], "left").select(
        "method", "query_id", F.coalesce(1 / F.col("best"), F.lit(0.0)).alias("rr"))


def mrr_at_k(ranked: DataFrame, golden: DataFrame, methods: list[str], k: int = 5,
             match: str = "prefix80") -> DataFrame:
    """``(method, mrr, questions)``."""
    return reciprocal_ranks(ranked, golden, methods, k, match).groupBy("method").agg(
        F.avg("rr").alias("mrr"), F.count("*").alias("questions"))


def mrr_gain(per_question: DataFrame, before: str, after: str) -> DataFrame:
    """One row: both means, improvement in percent, questions improved and degraded."""
    of = lambda m: F.max(F.when(F.col("method") == m, F.col("rr")))
    both = per_question.groupBy("query_id").agg(of(before).alias("b"), of(after).alias("a"))
    return both.agg(
        F.avg("b").alias("mrr_before"),
        F.avg("a").alias("mrr_after"),
        ((F.avg("a") - F.avg("b")) / (F.avg("b") + 1e-9) * 100).alias("improvement_pct"),
        F.count_if(F.col("a") > F.col("b")).alias("improved"),
        F.count_if(F.col("a") < F.col("b")).alias("degraded"))


def score_gap(scored: DataFrame, relevant: Column, score: str = "score") -> DataFrame:
    """Mean score of relevant and other rows and the distance between the two."""
    good = F.avg(F.when(relevant, F.col(score)))
    other = F.avg(F.when(~relevant, F.col(score)))
    return scored.agg(good.alias("relevant_mean"), other.alias("other_mean"), (good - other).alias("gap"),
                      F.count_if(relevant).alias("n_relevant"), F.count_if(~relevant).alias("n_other"))


def latency_summary(times: DataFrame, method: str, seconds: str, baseline: str) -> DataFrame:
    """Mean and interpolated 99th percentile per method, and the mean relative to ``baseline``."""
    base = times.filter(F.col(method) == baseline).agg(F.avg(seconds)).scalar()
    named = times.withColumn("method", F.col(method))
    means = named.groupBy("method").agg(F.avg(seconds).alias("mean"), F.count("*").alias("trials"))
    p99 = exact_percentiles(named, seconds, [0.99], ["method"]).select(F.col("method").alias("_m"), F.col("percentile").alias("p99"))
    return means.join(p99, F.col("method").eqNullSafe(F.col("_m")), "left").select(
        "method", "mean", "p99", "trials", (F.col("mean") / base).alias("ratio"))


def histogram(df: DataFrame, value: str, bins: int, by: str | None = None) -> DataFrame:
    """Counts in ``bins`` equal ranges between the overall minimum and maximum; the last is closed."""
    if bins < 1:
        raise ValueError("bins must be at least 1")
    edges = df.agg(F.struct(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high")).alias("e")).scalar()
    low, high = edges["low"], edges["high"]  # one subquery for both
    x = F.col(value).cast("double")
    place = F.when(high == low, F.lit(0)).otherwise(
        F.least(F.floor((x - low) / (high - low) * bins), F.lit(bins - 1))).cast("int")
    keys = ([by] if by else []) + ["bin"]
    counted = df.filter(F.col(value).isNotNull()).withColumn("bin", place).groupBy(*keys).agg(
        F.count("*").alias("n"))
    width = (high - low) / bins
    return counted.withColumn("bin_start", low + F.col("bin") * width).withColumn(
        "bin_end", low + (F.col("bin") + 1) * width)


def scorer_correlation(left: DataFrame, right: DataFrame, keys: list[str], score: str = "score") -> DataFrame:
    """Pearson correlation of two score tables over their common rows."""
    both = left.select(*keys, F.col(score).alias("a")).join(right.select(*keys, F.col(score).alias("b")), keys)
    return both.agg(F.corr("a", "b").alias("correlation"), F.count("*").alias("pairs"))


def complete_answers(golden: DataFrame, answers: DataFrame) -> DataFrame:
    """Answer rows for every question: no answer becomes ``''``, no contexts the golden ones.

    ``golden`` has ``query_id, question, ground_truth, contexts``; ``answers`` has
    ``query_id, answer, retrieved`` (an array).
    """
    both = golden.join(answers, "query_id", "left")
    found = F.size(F.coalesce("retrieved", F.array().cast("array<string>"))) > 0
    return both.select("query_id", "question", "ground_truth", F.coalesce("answer", F.lit("")).alias("answer"),
                       F.when(found, F.col("retrieved")).otherwise(F.col("contexts")).alias("contexts"))


def judged_metrics(verdicts: DataFrame) -> DataFrame:
    """``(metric, score)``: mean over questions of the share of positive verdicts.

    ``verdicts`` has ``query_id, metric, verdict`` with one row per judged claim,
    passage or part: faithfulness, context_precision, context_recall. A metric
    that has only unknown (null) verdicts scores 0.
    """
    per_question = verdicts.groupBy("metric", "query_id").agg(F.avg(F.col("verdict").cast("int")).alias("share"))
    return per_question.groupBy("metric").agg(F.coalesce(F.avg("share"), F.lit(0.0)).alias("score"))


def answer_relevancy(answers: DataFrame, embedder: Embedder, question: str = "question",
                     answer: str = "answer") -> DataFrame:
    """One row ``(answer_relevancy, score)``: mean cosine of question and answer."""
    sims = answers.select(vx.cosine(embedder.vector(F.col(question), False),
                                    embedder.vector(F.col(answer), False)).alias("s"))
    return sims.agg(F.coalesce(F.avg("s"), F.lit(0.0)).alias("score")).select(
        F.lit("answer_relevancy").alias("metric"), "score")


def threshold_report(metrics: DataFrame, baseline: DataFrame | None = None,
                     thresholds: dict[str, float] = STRONG_THRESHOLDS) -> DataFrame:
    """Score, threshold and status per metric; with a baseline also its score and the difference.

    A missing metric counts as 0.
    """
    spark = metrics.sparkSession
    wanted = spark.createDataFrame(list(thresholds.items()), "metric string, threshold double")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    out = wanted.join(metrics.select("metric", "score"), "metric", "left").select(
        "metric", zero(F.col("score")).alias("score"), "threshold")
    if baseline is not None:
        old = baseline.select("metric", F.col("score").alias("_old"))
        out = out.join(old, "metric", "left").withColumn("baseline", zero(F.col("_old"))).withColumn(
            "delta", F.col("score") - F.col("baseline")).drop("_old")
    return out.withColumn("status", F.when(F.col("score") >= F.col("threshold"), "PASS").otherwise("FAIL"))


def mean_of_metrics(metrics: DataFrame) -> DataFrame:
    """One row: the mean of the metrics that are present, 0 when there are none."""
    return metrics.agg(F.coalesce(F.avg("score"), F.lit(0.0)).alias("average"))

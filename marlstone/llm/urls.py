"""URL filter: rules first, then a ratio of two character language models.

Urls that the rules accept or reject train one model each: Markov models of variable
order over 40 classes of characters, in which a context of two characters falls back
to one, none, and the even distribution, as far as it has been seen (Witten-Bell
weights). A url without a rule is judged by the mean log-likelihood difference per
character against a threshold that is calibrated on labelled urls the models have
not seen.

The models come down to one number for each three classes in a row (64,000 at any size of the
corpus), which every task gets as a constant array: scoring stays in the row. What is
shuffled are counts, added up before.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/"))
LETTERS = string.ascii_lowercase + "0/.-_?=&%#:~"  # digits count as 0, all that is not listed as one class
CLASSES, START = 40, 39
MICRO = 1_000_000  # log-likelihood ratios are whole millionths, so sums do not depend on their order
STEP, REACH = 10_000, 800  # calibration bins of a hundredth, from -8 to 8
HELD_PART = 4  # one of so many labelled urls calibrates


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null or a text without ``://``."""
    whole, pattern = F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return lower_ascii(F.regexp_extract(whole, pattern, 1)), F.regexp_extract(whole, pattern, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: -len(r[1])):
        at = text.index("/") if "/" in text else len(text)
        name, start = text[:at], text[at:]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    return (rule, verdict) if rule is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def triples(url: Column) -> Column:
    """For each character of the url without its scheme: the classes of the two before it and its own, as one number."""
    body = F.regexp_replace(lower_ascii(F.coalesce(url, F.lit(""))), r"(?s)^.*?://", "")
    body = F.translate(body, "123456789", "0" * 9)
    codes = F.transform(F.regexp_extract_all(body, F.lit(r"(?s)."), F.lit(0)), lambda c: F.instr(F.lit(LETTERS), c))

    def numbered(own: Column) -> Column:
        at = lambda i: F.coalesce(F.get(own, i), F.lit(START))
        return F.transform(own, lambda c, i: (at(i - 2) * CLASSES + at(i - 1)) * CLASSES + c)

    return F.transform(F.array(codes), numbered)[0]


def log_ratios(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """``triple, ratio`` (millionths) for all triples from ``triple, allow, block`` counts."""
    grid = spark.range(CLASSES ** 3).select(
        F.col("id").alias("triple"), F.expr(f"id div {CLASSES ** 2}").alias("a"),
        F.expr(f"id div {CLASSES} % {CLASSES}").alias("b"), F.expr(f"id % {CLASSES}").alias("c"))
    grid = grid.join(counts.withColumn("triple", F.col("triple").cast("long")), "triple", "left").fillna(0)
    one = Window.partitionBy("whole")
    grid = grid.withColumn("whole", F.lit(0))
    logs = {}
    for kind in ("allow", "block"):
        n = F.col(kind)
        grid = grid.withColumns({f"{kind}_bc": F.sum(n).over(Window.partitionBy("b", "c")),
                                 f"{kind}_c": F.sum(n).over(Window.partitionBy("c"))})
        first = (F.col("a") == 0).cast("int")
        corner = ((F.col("a") == 0) & (F.col("b") == 0)).cast("int")
        seen = lambda column, window, part: F.sum((F.col(column) > 0).cast("int") * part).over(window)
        grid = grid.withColumns({
            f"{kind}_n2": F.sum(n).over(Window.partitionBy("a", "b")),
            f"{kind}_t2": seen(kind, Window.partitionBy("a", "b"), F.lit(1)),
            f"{kind}_n1": F.sum(n).over(Window.partitionBy("b")),
            f"{kind}_t1": seen(f"{kind}_bc", Window.partitionBy("b"), first),
            f"{kind}_n0": F.sum(n).over(one), f"{kind}_t0": seen(f"{kind}_c", one, corner)})
        p = F.lit(1.0 / CLASSES)
        for count, order in ((f"{kind}_c", 0), (f"{kind}_bc", 1), (kind, 2)):
            total, kinds = F.col(f"{kind}_n{order}"), F.col(f"{kind}_t{order}")
            p = F.when(total > 0, (F.col(count) + kinds * p) / (total + kinds)).otherwise(p)
        logs[kind] = F.log(p)
    return grid.select("triple", F.round((logs["allow"] - logs["block"]) * MICRO).cast("int").alias("ratio"))


def _constant(values: list[int]) -> Column:
    """One array for all rows; the optimizer folds it to a constant."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def score(parts: Column, ratios: list[int]) -> Column:
    """Millionths of log-likelihood difference per character; 0 for an empty url."""
    table = _constant(ratios)
    total = F.aggregate(parts, F.lit(0).cast("long"), lambda a, t: a + F.get(table, t))
    return F.floor(total / F.greatest(F.size(parts), F.lit(1))).cast("long")


def calibrate(bins: list[tuple[int, int, int]]) -> int:
    """The threshold with the smallest sum of both error rates, from ``(bin, allowed, blocked)``; the middle one on ties."""
    allowed, blocked = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not allowed or not blocked:
        return 0
    missed, passed, costs = 0, blocked, [(blocked / blocked, -REACH)]
    for number, a, b in sorted(bins):
        missed, passed = missed + a, passed - b
        costs.append((missed / allowed + passed / blocked, number + 1))
    least = min(c for c, _ in costs)
    best = [n for c, n in costs if c <= least + 1e-12]
    return best[len(best) // 2] * STEP


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, score, threshold`` (scores in millionths).

    ``pages`` needs ``page_id`` and ``url``; other columns are ignored. A null or empty url has
    score 0; rows alike are judged alike; without urls on both sides of the rules
    the threshold is 0; an empty table gives no rows.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.select("page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("ruled"),
                           triples(F.col("url")).alias("triples"))
    labelled = judged.where("ruled is not null").withColumn(
        "held", F.pmod(F.xxhash64(F.lit("held"), "url"), F.lit(HELD_PART)) == 0)
    is_ = lambda kind: F.sum((F.col("ruled") == kind).cast("int")).alias(kind)
    counts = (labelled.where("not held").select("ruled", F.explode("triples").alias("triple"))
              .groupBy("triple").agg(is_("allow"), is_("block")))
    ratios = [r.ratio for r in log_ratios(spark, counts).orderBy("triple").collect()]  # CLASSES ** 3 numbers
    number = F.greatest(F.least(F.floor(score(F.col("triples"), ratios) / STEP), F.lit(REACH)), F.lit(-REACH))
    bins = labelled.where("held").groupBy(number.alias("bin")).agg(is_("allow"), is_("block")).collect()  # 2 * REACH + 1 at most
    threshold = calibrate([tuple(b) for b in bins])
    scored = judged.withColumn("score", score(F.col("triples"), ratios))
    by_model = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score",
                         F.lit(threshold).cast("long").alias("threshold"))

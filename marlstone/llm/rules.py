"""Quality rules with thresholds read from the data of each language and source.

Four measures of every document that passes the base rule are gathered in mergeable
quantile sketches: counts per bucket, where a bucket holds integers that agree in
their leading six bits (values are known to 3 percent). Sketches of one language and
source add up to those of the language and of the corpus. The quartiles of a sketch
give fences, ``FENCE`` times the interquartile distance beyond them, and the fences
are joined back to the documents. Where nearly all values are equal the distance is
zero; a fence then keeps ``MARGIN`` away from its quartile, so that clean documents of
a uniform source do not fall.

All of it is built-in functions; the longest group of a window has some hundred buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import BLANKS, join_safe, words
from marlstone.session import staged

SYMBOLS = "#*$%&|<>"
MILLION = 1_000_000
FENCE, LEAST_ROWS = 3, 50
# Per measure (in millionths): the least distance of a fence from its quartile, and whether low values fail too.
MARGIN = {"symbols": (20_000, False), "dup_lines": (300_000, False), "repeats": (250_000, False), "word_length": (1_500_000, True)}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(tokens: Column) -> Column:
    """Words in three-word windows that occur twice or more among ``tokens``, the first occurrence included."""
    def of_hashes(hashes: Column) -> Column:
        marked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda x, i: x["h"].eqNullSafe(F.get(s, i)["h"])
            return F.sort_array(F.array_compact(F.transform(s, lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["i"]))))

        def covered(p: Column) -> Column:
            steps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

        found = _let(_let(marked, places), covered)
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), found).otherwise(F.lit(0).cast("long"))

    windows = F.transform(F.sequence(F.lit(0), F.greatest(F.size(tokens) - 3, F.lit(0))),
                          lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)))
    return F.when(F.size(tokens) >= 3, _let(windows, of_hashes)).otherwise(F.lit(0).cast("long"))


def base_measures(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the five base counts, ``base_failed`` and the measures in millionths."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda v: F.btrim(v, F.lit(BLANKS)) != "")
    counted = _let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                                   repeated_words(w).alias("n_repeat_words")))
    of_lines = _let(lines, lambda v: F.struct(F.size(v).cast("long").alias("n_lines"),
                                              (F.size(v) - F.size(F.array_distinct(v))).cast("long").alias("n_dup_lines")))
    found = docs.select(
        "doc_id", "lang", "source", counted.alias("w"), of_lines.alias("v"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    found = found.select("doc_id", "lang", "source", "w.*", "v.*", "word_chars", "n_symbols")
    share = lambda a, b: F.expr(f"{a} * {MILLION} div greatest({b}, 1)")
    return found.select(
        "doc_id", "lang", "source", *BASE,
        F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words").alias("base_failed"),
        share("n_symbols", "word_chars").alias("symbols"), share("n_dup_lines", "n_lines").alias("dup_lines"),
        share("n_repeat_words", "n_words").alias("repeats"), share("word_chars", "n_words").alias("word_length"))


def bucket(value: Column) -> Column:
    """The sketch bucket of a number from 0 on."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return (shift * 32 + F.floor(value / F.pow(F.lit(2.0), shift))).cast("long")


def bucket_top(number: Column) -> Column:
    """The largest value of a bucket."""
    shift = F.greatest(F.floor(number / 32) - 1, F.lit(0))
    return ((number - shift * 32 + 1) * F.pow(F.lit(2.0), shift)).cast("long") - 1


def sketches(measures: DataFrame) -> DataFrame:
    """``lang, source, measure, bucket, n``: counts that are added up before and after the shuffle."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in MARGIN])
    sound = measures.where(~F.col("base_failed")).select("lang", "source", F.explode(pairs).alias("v"))
    return sound.groupBy("lang", "source", "v.measure", "v.bucket").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Sketches added up over all columns but ``keys``."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Per ``keys``: ``rows`` and ``<measure>_low``, ``<measure>_high``."""
    group = Window.partitionBy(*keys, "measure")
    upto = sketch.withColumns({"rows": F.sum("n").over(group), "upto": F.sum("n").over(group.orderBy("bucket"))})
    at = lambda quarter: F.min(F.when(F.col("upto") * 4 >= F.col("rows") * quarter, bucket_top(F.col("bucket"))))
    quartiles = upto.groupBy(*keys, "measure").agg(F.max("rows").alias("rows"), at(1).alias("q1"), at(3).alias("q3"))
    columns = [F.max("rows").alias("rows")]
    for measure, (margin, both) in MARGIN.items():
        here = F.col("measure") == measure
        reach = F.greatest(FENCE * (F.col("q3") - F.col("q1")), F.lit(margin))
        columns.append(F.max(F.when(here, F.col("q3") + reach)).alias(f"{measure}_high"))
        columns.append(F.max(F.when(here, F.col("q1") - reach if both else F.lit(-1))).alias(f"{measure}_low"))
    return quartiles.groupBy(*keys).agg(*columns)


def thresholds(measures: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Fences of every language and source; below ``least_rows`` those of the language, then of the corpus."""
    sketch = staged(sketches(measures))
    own, by_lang = fences(sketch, ("lang", "source")), fences(merged(sketch, ("lang",)), ("lang",))
    whole = fences(merged(sketch, ()), ()).first()
    sides = [f"{m}_{s}" for m in MARGIN for s in ("low", "high")]
    by_lang = by_lang.select("lang", F.col("rows").alias("lang_rows"), *[F.col(s).alias(f"lang_{s}") for s in sides])
    rest = {s: F.lit(whole[s]).cast("long") for s in sides} if whole else {s: F.lit(None).cast("long") for s in sides}
    pick = lambda s: F.when(F.col("rows") >= least_rows, F.col(s)).when(
        F.col("lang_rows") >= least_rows, F.col(f"lang_{s}")).otherwise(rest[s]).alias(s)
    return join_safe(own, by_lang, ["lang"]).select("lang", "source", *[pick(s) for s in sides])


def judge(docs: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """One row per document: ``doc_id``, the base counts, ``base_failed``, ``kept`` and the four measures.

    ``docs`` needs ``doc_id, text, lang, source``. A null text has no words and fails the
    base rule; null languages and sources are groups of their own; rows alike are judged
    alike; other columns are ignored; an empty table gives no rows.
    """
    measures = staged(base_measures(docs))
    judged = join_safe(measures, thresholds(measures, least_rows), ["lang", "source"], "left")
    inside = F.lit(True)
    for m in MARGIN:
        inside = inside & F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return judged.select("doc_id", *BASE, "base_failed", kept.alias("kept"), *MARGIN)


def judge_sql(least_rows: int = LEAST_ROWS) -> str:
    words_ = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
    sides = [(m, margin, both) for m, (margin, both) in MARGIN.items()]

    def fence(name: str, source: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        columns = ", ".join(
            f"max(CASE WHEN measure = '{m}' THEN q3 + greatest({FENCE} * (q3 - q1), {margin}) END) AS {m}_high, "
            f"max(CASE WHEN measure = '{m}' THEN {f'q1 - greatest({FENCE} * (q3 - q1), {margin})' if both else '-1'} END) AS {m}_low"
            for m, margin, both in sides)
        return f"""
{name}_u AS (SELECT *, sum(n) OVER (PARTITION BY {by}measure) AS rows_,
    sum(n) OVER (PARTITION BY {by}measure ORDER BY bucket) AS upto FROM {source}),
{name}_q AS (SELECT {by}measure, max(rows_) AS rows_,
    min(CASE WHEN upto * 4 >= rows_ THEN top END) AS q1, min(CASE WHEN upto * 4 >= rows_ * 3 THEN top END) AS q3
  FROM (SELECT *, ((bucket - greatest(bucket // 32 - 1, 0) * 32 + 1) << greatest(bucket // 32 - 1, 0)::INT) - 1 AS top FROM {name}_u)
  GROUP BY ALL),
{name} AS (SELECT {by}max(rows_) AS rows_, {columns} FROM {name}_q GROUP BY ALL)"""

    def pick(m: str, side: str) -> str:
        return (f"CASE WHEN o.rows_ >= {least_rows} THEN o.{m}_{side} WHEN l.rows_ >= {least_rows} THEN l.{m}_{side} "
                f"ELSE c.{m}_{side} END")

    inside = " AND ".join(f"m.{m} BETWEEN {pick(m, 'low')} AND {pick(m, 'high')}" for m in MARGIN)
    values = ", ".join(f"('{m}', {m})" for m in MARGIN)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text, {words_} AS w FROM documents),
win AS (SELECT r, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM dup, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
b AS (SELECT d.r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda v: regexp_matches(v, '[^\\x20\\x09-\\x0D]')) AS v,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN rep USING (r)),
b2 AS (SELECT * EXCLUDE v, len(v)::BIGINT AS n_lines, (len(v) - len(list_distinct(v)))::BIGINT AS n_dup_lines FROM b),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_symbols * {MILLION} // greatest(word_chars, 1) AS symbols, n_dup_lines * {MILLION} // greatest(n_lines, 1) AS dup_lines,
    n_repeat_words * {MILLION} // greatest(n_words, 1) AS repeats, word_chars * {MILLION} // greatest(n_words, 1) AS word_length FROM b2),
x AS (SELECT lang, source, measure, value, greatest(length(bin(value)) - 6, 0) AS shift
  FROM m, LATERAL (VALUES {values}) t(measure, value) WHERE NOT base_failed),
s AS (SELECT lang, source, measure, shift * 32 + (value >> shift::INT) AS bucket, count(*) AS n FROM x GROUP BY ALL),
sl AS (SELECT lang, measure, bucket, sum(n) AS n FROM s GROUP BY ALL),
sc AS (SELECT measure, bucket, sum(n) AS n FROM s GROUP BY ALL),
{fence('own', 's', 'lang, source').strip()}, {fence('lng', 'sl', 'lang').strip()}, {fence('cor', 'sc', '').strip()}
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({inside}, false) AS kept, symbols, dup_lines, repeats, word_length
FROM m LEFT JOIN own o ON m.lang IS NOT DISTINCT FROM o.lang AND m.source IS NOT DISTINCT FROM o.source
LEFT JOIN lng l ON m.lang IS NOT DISTINCT FROM l.lang CROSS JOIN cor c"""

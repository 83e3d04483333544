"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source that is to give ``r`` times its size is taken ``floor(r)``
times for certain; the fraction that is left is a probability of one more copy.
Documents of a source are paired, and mass measured in words moves at random from one
to the other until one probability is 0 or 1; the other goes on. Every step keeps each
document's expected copies and the source's expected words exactly, so a source ends
within one document of its target.

Pairs are taken in buckets of about ``BUCKET`` documents, one fold per bucket; what each
bucket leaves over is folded again, bucket by bucket, until one document per source
is left: a reduction tree, in which no task holds more than a bucket of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import before, draw, in_runs, join_safe, n_words, text_key
from marlstone.session import stack, staged

WEIGHTS = (5, 2, 1)  # by place of the source in code point order, repeating
MOST = 3  # times its own size that a source may give
BUCKET = 64
REPEATS = 65536
NEAR = 1e-9


def targets(items: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, n, target`` from ``source, size, m`` (rows of ``size`` words, ``m`` alike; ``n`` rows in all).

    All words are shared by weight; a source stops at ``most`` times its size and the
    rest is shared again. In order of cap over weight, a source stops exactly if
    its share of what those before it leave is not below its cap, so one running
    sum replaces the rounds.
    """
    sources = in_runs(items.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"),
                                                  F.sum("m").alias("n")),
                      [], [F.col("source").asc_nulls_last()])
    ranked = before(sources, [], [F.col("source").asc_nulls_last()], {"place": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = ranked.select("source", "source_size", "n", weight.alias("w"), (most * F.col("source_size")).alias("cap"))
    ranked = in_runs(ranked.withColumn("ratio", F.col("cap") / F.col("w")), [], ["ratio", F.col("source").asc_nulls_last()])
    words, share = ranked.agg(F.sum("source_size"), F.sum("w")).first()
    words, share = F.lit(words or 0), F.lit(share or 0)
    run = before(ranked, [], ["ratio", F.col("source").asc_nulls_last()], {"caps": "cap", "ws": "w"})
    stops = F.col("ratio") * (share - F.col("ws")) <= words - F.col("caps")
    run = staged(run.withColumn("stops", stops))
    caps, ws = run.where("stops").agg(F.sum("cap"), F.sum("w")).first()
    level = (words - F.lit(caps or 0)) / (share - F.lit(ws or 0))
    target = F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(level * F.col("w"))
    return run.select("source", "source_size", "n", target.alias("target"))


def _field(item: Column, name: str) -> Column:
    return item.getField(name)


ITEM = ("doc_id", "_h", "_g", "size", "m", "nr")


def _item(source: Column, p: Column) -> Column:
    return F.struct(*[_field(source, c).alias(c) for c in ITEM], p.cast("double").alias("p"))


def _done(source: Column, up: Column) -> Column:
    return F.struct(*[_field(source, c).alias(c) for c in ITEM], up.cast("int").alias("up"))


def _meet(state: Column, item: Column) -> Column:
    """One step of the fold: the document carried so far meets the next one."""
    held, out = _field(state, "held"), _field(state, "out")

    def moved(v: Column) -> Column:
        a, b, rise = (_field(v, c) for c in ("a", "b", "rise"))
        p, q = _field(held, "p"), _field(item, "p")
        s, t = _mass(held), _mass(item)
        p2 = F.when(rise, p + a / s).otherwise(p - b / s)
        q2 = F.when(rise, q - a / t).otherwise(q + b / t)
        return F.struct(p2.alias("p"), q2.alias("q"))

    def settle(v: Column) -> Column:
        p, q = _field(v, "p"), _field(v, "q")
        p_ends, q_ends = (p < NEAR) | (p > 1 - NEAR), (q < NEAR) | (q > 1 - NEAR)
        finished = F.when(p_ends & q_ends, F.array(_done(held, p > 0.5), _done(item, q > 0.5))).when(
            p_ends, F.array(_done(held, p > 0.5))).otherwise(F.array(_done(item, q > 0.5)))
        left = F.when(p_ends & q_ends, F.lit(None)).when(p_ends, _item(item, q)).otherwise(_item(held, p))
        return F.struct(left.alias("held"), F.concat(out, finished).alias("out"))

    p, q, s, t = _field(held, "p"), _field(item, "p"), _mass(held), _mass(item)
    up, down = F.least((1 - p) * s, q * t), F.least(p * s, (1 - q) * t)
    named = [_field(v, c) for v in (held, item) for c in ("_h", "doc_id", "nr")]
    chance = draw(F.lit("pair"), *named)
    drawn = F.struct(up.alias("a"), down.alias("b"), (chance * (up + down) < down).alias("rise"))
    step = F.transform(F.transform(F.array(drawn), moved), settle)[0]
    return F.when(held.isNull(), F.struct(_item(item, _field(item, "p")).alias("held"), out.alias("out"))).otherwise(step)


def _mass(item: Column) -> Column:
    return _field(item, "size").cast("double")


def _folded(items: DataFrame, buckets: Column) -> DataFrame:
    """One fold per source and bucket: ``source, n, bucket, held, out``."""
    inside = F.struct(F.xxhash64(F.lit("order"), "_h", "_g", "doc_id", "nr").alias("key"), *ITEM, "p")
    bucketed = items.withColumn("bucket", F.pmod("place", buckets))
    grouped = bucketed.groupBy("source", "n", "bucket").agg(F.sort_array(F.collect_list(inside)).alias("items"))
    fields = ",".join(f"{c}:{items.schema[c].dataType.simpleString()}" for c in ITEM)
    none = F.lit(None).cast(f"struct<{fields},p:double>")
    empty = F.lit([]).cast(f"array<struct<{fields},up:int>>")
    start = F.struct(none.alias("held"), empty.alias("out"))
    state = F.aggregate("items", start, _meet)
    return grouped.select("source", "n", "bucket", state.alias("state")).select("source", "n", "bucket", "state.*")


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, bucket: int = BUCKET) -> DataFrame:
    """How often each document is taken.

    ``docs`` needs ``doc_id``, ``text`` and ``source``. Returns one row for each of its rows:
    ``doc_id, _h, _g, source`` (the two hashes of the text), ``nr`` from 1 to ``m`` among the
    ``m`` rows alike in these, ``size`` in words, ``source_size``, ``target``, ``copies``.
    Rows alike are documents of their own, each with its own decision. Null texts have size 0; documents of no words are taken by a draw of
    their own, as they carry no mass; a null source is the last one.
    """
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *text_key(F.col("text")))
    items = staged(sized.groupBy("doc_id", "source", "_h", "_g", "size").agg(F.count("*").alias("m")))
    goals = staged(targets(items, weights, most))
    items = items.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / REPEATS))))
    here = F.least(F.col("m") - F.col("_block") * REPEATS, F.lit(REPEATS))
    items = items.withColumn("_place", F.explode(F.sequence(F.lit(1).cast("long"), here)))
    items = items.withColumn("nr", F.col("_block") * REPEATS + F.col("_place")).drop("_block", "_place")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    items = join_safe(items, goals, ["source"]).withColumn("rate", rate)
    whole = F.floor(F.col("rate") + NEAR)
    items = items.withColumns({"whole": whole.cast("int"), "p": F.greatest(F.col("rate") - whole, F.lit(0.0))})
    sure = items.where("p <= 1e-9").withColumn("up", F.lit(0))
    empty = items.where("p > 1e-9 and size = 0").withColumn(
        "up", (draw(F.lit("empty"), "_h", "doc_id", "nr") < F.col("p")).cast("int"))
    open_ = items.where("p > 1e-9 and size > 0").withColumn("place", F.xxhash64(F.lit("place"), "_h", "_g", "doc_id", "nr"))
    most_items = goals.agg(F.max("n")).first()[0] or 0
    decided, width = [], bucket
    while True:
        folded = staged(_folded(open_, F.ceil(F.col("n") / width)))
        decided.append(folded.select("source", F.explode("out").alias("d")).select("source", "d.*"))
        if width >= most_items:
            break
        open_ = folded.where("held is not null").select("source", "n", "held.*", F.col("bucket").alias("place"))
        width *= bucket
    rest = folded.where("held is not null").select("source", "held.*")
    rest = rest.withColumn("up", (draw(F.lit("rest"), "_h", "doc_id", "nr") < F.col("p")).cast("int")).drop("p")
    ups = stack(*decided, rest)
    goals = goals.drop("n")
    fraction = join_safe(ups, goals, ["source"]).withColumn("rate", rate).withColumn("whole", whole.cast("int"))
    columns = ("doc_id", "source", *ITEM[1:], "source_size", "target",
               (F.col("whole") + F.col("up")).alias("copies"))
    return stack(*[part.select(*columns) for part in (sure, empty, fraction)])


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, bucket: int = BUCKET) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, copies``; ``taken`` counts repeats.

    An empty table gives no rows. The draw depends on ids and texts only, so reruns agree.
    """
    rows = copies(docs, weights, most, bucket)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with every row as often as it is taken; columns stay as they are, whatever their names.

    Rows alike in id, source and text are numbered, in any order, where there are any.
    """
    keys = ["_h", "_g", "doc_id", "source"]
    chosen = staged(copies(docs, weights, most, bucket).where("copies > 0").select(*keys, "m", "nr", "copies"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), *text_key(F.col("text")), "doc_id", "source")
    once = join_safe(rows, chosen.where("m = 1"), keys)
    parts = [once.select("row", "copies")]
    again = chosen.where("m > 1")
    if not again.isEmpty():
        alike = join_safe(rows, again.select(*keys).distinct(), keys, "left_semi")
        runs = in_runs(alike.withColumn("_order", F.monotonically_increasing_id()), keys, ["_order"])
        placed = before(runs, keys, ["_order"], {"_earlier": F.lit(1)}).withColumn("nr", F.col("_earlier") + 1)
        parts.append(join_safe(placed, again, [*keys, "nr"]).select("row", "copies"))
    taken = stack(*parts)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")

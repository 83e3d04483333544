"""Exact percentiles without a group held in one place.

The rank that a percentile asks for is found by refining: the rows of a group are
counted in buckets between splitters, only the bucket that holds the rank goes
on, and so forth until it is small enough to be sorted in one task. Every count is
combined before its shuffle, so a group with nearly all rows is dealt over all
tasks like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.session import stack, staged

SORTED = 100_000  # rows of a cell that one task may sort
SPLITTERS = 128  # buckets of a round, about


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null meets null."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def exact_percentiles(df: DataFrame, value: str, fractions: Sequence[float], by: Sequence[str] = (),
                      sorted_rows: int = SORTED, splitters: int = SPLITTERS) -> DataFrame:
    """``by`` columns, ``fraction``, ``percentile``: interpolated between the two nearest values, as ``percentile`` does.

    Null values do not count, NaN is the largest value. A group without values has
    no row; a null in ``by`` is a group of its own.
    """
    if not all(0 <= p <= 1 for p in fractions):
        raise ValueError("fractions must lie between 0 and 1")
    keys = [*by, "_cell"]
    rows = df.select(*by, F.lit("").alias("_cell"), F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    cells = staged(rows.groupBy(*keys).agg(F.count("*").alias("n")))
    asked = F.explode(F.array(*[F.lit(float(p)) for p in fractions]))
    places = cells.withColumn("fraction", asked).withColumn("_at", F.col("fraction") * (F.col("n") - 1))
    ends = F.explode(F.array(F.struct(F.lit("low").alias("end"), F.floor("_at").alias("rank")),
                             F.struct(F.lit("high").alias("end"), F.ceil("_at").alias("rank"))))
    targets = staged(places.withColumn("_e", ends).select(*keys, "fraction", (F.col("_at") - F.floor("_at")).alias("_part"),
                                                          F.col("_e.end").alias("_end"), F.col("_e.rank").cast("long").alias("_rank")))
    found = []
    while True:
        few = cells.filter(F.col("n") <= sorted_rows).select(*keys)
        many = cells.filter(F.col("n") > sorted_rows).select(*keys)
        ordered = _same(rows, few, keys, "left_semi").groupBy(*keys).agg(F.sort_array(F.collect_list("_v")).alias("_all"))
        found.append(_same(targets, ordered, keys).withColumn("_v", F.get("_all", F.col("_rank").cast("int"))).drop("_all"))
        if many.isEmpty():
            break
        rows, cells, targets, done = _refined(_same(rows, many, keys, "left_semi"), _same(targets, many, keys, "left_semi"),
                                              keys, splitters)
        found.append(done)
    ends = stack(*[f.select(*by, "fraction", "_part", "_end", "_v") for f in found])
    pick = lambda end: F.max(F.when(F.col("_end") == end, F.col("_v")))
    both = ends.groupBy(*by, "fraction", "_part").agg(pick("low").alias("_low"), pick("high").alias("_high"))
    # equal ends are taken as they are: an infinite value has no distance to itself
    value_ = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(
        F.col("_low") * (1 - F.col("_part")) + F.col("_high") * F.col("_part"))
    return both.select(*by, "fraction", value_.alias("percentile"))


def _refined(rows: DataFrame, targets: DataFrame, keys: list[str], splitters: int):
    """One round: rows, cells and targets of the buckets that go on, and the targets whose value is known.

    A splitter is a value of the cell. Values equal to it are a bucket of their
    own, so every round parts a cell, whatever its values.
    """
    steps = F.array(*[F.lit((i + 1) / (splitters + 1)) for i in range(splitters)])
    cut = staged(rows.groupBy(*keys).agg(F.array_distinct(F.percentile_approx("_v", steps, 100 * splitters)).alias("_s")))
    place = F.size(F.filter("_s", lambda s: s < F.col("_v"))) * 2 + F.array_contains("_s", F.col("_v")).cast("int")
    dealt = _same(rows, cut, keys).withColumn("_b", place).drop("_s")
    counts = dealt.groupBy(*keys, "_b").agg(F.count("*").alias("n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # at most 2 * splitters + 1 rows
    counts = staged(counts.withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    hit = _same(targets, counts, keys).filter((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("n")))
    hit = staged(hit)
    known = F.col("_least") == F.col("_most")
    done = hit.filter(known).select(*targets.columns, F.col("_least").alias("_v"))
    deeper = F.concat_ws("/", "_cell", F.col("_b").cast("string"))
    open_ = hit.filter(~known)
    left = [k for k in keys if k != "_cell"]
    targets = open_.select(*left, deeper.alias("_cell"), "fraction", "_part", "_end", (F.col("_rank") - F.col("_before")).alias("_rank"))
    cells = open_.select(*left, deeper.alias("_cell"), "n").distinct()
    kept = dealt.select(*left, deeper.alias("_cell"), "_v")
    return staged(_same(kept, cells.select(*keys), keys, "left_semi")), staged(cells), staged(targets), done

"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from marlstone.session import stack, staged


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang neighbours on the smallest node around: the larger ones, or the smaller ones and the node itself.

    The smallest neighbour is an aggregate that is combined before the shuffle,
    and the join back may be split where a node has very many neighbours.
    """
    ways = stack(edges, edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not larger:
        ways = ways.where("v < u")
    least = ways.groupBy(F.col("u").alias("c")).agg(F.least(F.first("u"), F.min("v")).alias("m"))
    hung = ways.join(least, F.col("u") == F.col("c"))
    if larger:
        return hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    own = least.select(F.col("c").alias("u"), F.col("m").alias("v"))
    return stack(hung.select(F.col("v").alias("u"), F.col("m").alias("v")), own).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u``, ``v`` of one ordered type, no nulls).

    ``root`` is the smallest node that can be reached. Each round is written to the
    shared folder, so a lost executor costs one round; rounds go on until nothing
    changes (their number grows with the logarithm of the longest chain).
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    mark = None
    while True:
        seen = Observation()  # filled by the write itself
        edges = staged(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("mark")))
        now = seen.get
        if now == mark or not now.get("n"):
            break
        mark = now
        edges = _star(_star(edges, True), False)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stack(roots, edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()

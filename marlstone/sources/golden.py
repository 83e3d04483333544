"""The golden question set: a JSON array of
``{question, ground_truth, contexts, source}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.sources.documents import path_exists

GOLDEN = "question string, ground_truth string, contexts array<string>, source string"
REQUIRED = ("question", "ground_truth", "contexts")


def load_golden(spark: SparkSession, path: str) -> DataFrame:
    """Read and check; an item without a required key raises with its number and the keys."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"golden dataset not found: {path}")
    items = spark.read.schema(GOLDEN).json(path, multiLine=True).withColumn(
        "item", F.monotonically_increasing_id())
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]))
    bad = items.select("item", missing.alias("missing")).filter(F.size("missing") > 0).orderBy("item").limit(1).collect()
    if bad:
        raise ValueError(f"Item {bad[0]['item']} in golden dataset is missing keys: {set(bad[0]['missing'])}")
    return items

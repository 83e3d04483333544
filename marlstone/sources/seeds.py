"""The asset-class lookup and how to join it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASSET_CLASS_SCHEMA = (
    "asset_class_code string, asset_class_name string, is_alternative boolean, liquidity_tier int, "
    "typical_allocation_min_pct int, typical_allocation_max_pct int, solvency_capital_factor double"
)

# Fixed values of the seed table.
ASSET_CLASSES = [
    ("EQ", "Equity", False, 1, 20, 60, 0.39),
    ("FI", "Fixed Income", False, 1, 20, 60, 0.12),
    ("RE", "Real Estate", True, 3, 0, 20, 0.25),
    ("PE", "Private Equity", True, 4, 0, 15, 0.49),
    ("HF", "Hedge Funds", True, 3, 0, 10, 0.32),
    ("INFRA", "Infrastructure", True, 4, 0, 15, 0.30),
    ("CASH", "Cash & Equivalents", False, 1, 0, 10, 0.00),
]


def asset_classes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ASSET_CLASSES, ASSET_CLASS_SCHEMA)


def with_asset_class(df: DataFrame, code: str = "asset_class_code") -> DataFrame:
    """Asset-class columns next to each row; the lookup has seven rows and is sent to every task."""
    seed = asset_classes(df.sparkSession).withColumnRenamed("asset_class_code", code)
    return df.join(F.broadcast(seed), code, "left")

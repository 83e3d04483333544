"""CSV and text files to document rows:
``doc_id, text, source, type, row, title, category``."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from marlstone.session import stack
from marlstone.sources.split_csv import csv_records
from marlstone.sources.split_csv import header as csv_header

log = logging.getLogger(__name__)

ARTICLES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("authors", T.StringType()),
    T.StructField("source_journal", T.StringType()),
    T.StructField("word_count", T.IntegerType()),
])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or glob) exists on whatever file system it names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             multi_line: bool = True) -> DataFrame:
    """CSV with a header; without a schema every column is text, nothing is inferred.

    With ``multi_line`` every file is read by one task; ``split_csv.csv_records`` splits
    such files. Without it quoted values must not contain line breaks.
    """
    if schema is None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in csv_header(spark, path)])
    return (
        spark.read.schema(schema).option("header", True).option("multiLine", multi_line)
        .option("escape", '"').csv(path)
    )


def csv_documents(spark: SparkSession, path: str, key: str | None = "id") -> DataFrame:
    """One document per row; the text is ``abstract``, else the first column.

    ``key`` names the column that identifies a row. Without it the row number in
    the file is used. Large files are read by many tasks (see ``split_csv``).
    """
    columns = csv_header(spark, path)
    record = F.col("_record")
    text = "abstract" if "abstract" in columns else columns[0]
    row = record.getField(key).try_cast("long") if key and key in columns else F.col("_row")
    df = csv_records(spark, path).withColumns({"source": F.col("_file"), "row": row})
    extra = [record.getField(c).alias(c) if c in columns else F.lit(None).cast("string").alias(c) for c in ("title", "category")]
    return df.select(
        F.concat_ws("#", "source", "row").alias("doc_id"), record.getField(text).alias("text"), "source",
        F.lit("article").alias("type"), "row", *extra)


def text_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One document per file."""
    return spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"),
        F.col("_metadata.file_path").alias("source"), F.lit("text").alias("type"),
        F.lit(None).cast("long").alias("row"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("category"))


def load_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All given files by their suffix; missing ones are skipped with a warning."""
    parts = []
    for path in paths:
        if not path_exists(spark, path):
            log.warning("not found, skipped: %s", path)
        elif path.lower().endswith(".csv"):
            parts.append(csv_documents(spark, path))
        else:
            parts.append(text_documents(spark, path))
    if not parts:
        return spark.createDataFrame(
            [], "doc_id string, text string, source string, type string, row long, title string, category string")
    return stack(*parts)


def files_below(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """``(file_path)`` of the files with a suffix at any depth, sorted; a missing folder is empty."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], "file_path string")
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{suffix}").load(folder)
        .select(F.col("path").alias("file_path")).orderBy("file_path")
    )


def first_rows_per_file(df: DataFrame, limit: int | None = None, file: str = "_file", at: Column | str = "_at") -> DataFrame:
    """The first ``limit`` rows of each file in reading order; ``None`` keeps all rows."""
    if limit is None:
        return df
    w = Window.partitionBy(file).orderBy(at)
    return df.withColumn("_no", F.row_number().over(w)).filter(F.col("_no") <= limit).drop("_no")

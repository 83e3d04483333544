"""A full scan of CSV and text folders: findings, report and gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.operators import personal_data as pd_
from marlstone.sources import documents
from marlstone.sources.split_csv import csv_records
from marlstone.sources.tables import write_json_report
from marlstone.session import stack

FINDINGS = (
    "file_path string, file_type string, column_name string, entity_type string, row_count_with_pii long, "
    "example_values array<string>, allowed boolean, confidence_min double, confidence_max double"
)


class UnexpectedPersonalData(RuntimeError):
    """Raised by the gate."""


def scan_csv(spark: SparkSession, path: str, sample_rows: int | None = None, **options) -> DataFrame:
    """Findings of one CSV file (or glob of files with the same columns)."""
    columns = documents.csv_header(spark, path)
    df = documents.first_rows_per_file(csv_records(spark, path), sample_rows, at="_row")
    df = df.select(*[F.col("_record").getField(c).alias(c) for c in columns], F.struct("_file", "_row").alias("_of"))
    return pd_.column_findings(pd_.table_cells(df, columns, F.col("_of._file"), F.col("_of._row")), **options)


def scan_texts(spark: SparkSession, folder: str, **options) -> DataFrame:
    texts = (
        spark.read.option("wholetext", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.txt").text(folder)
        .select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text"))
    )
    options.pop("allowed_columns", None)
    return pd_.text_findings(texts, **options)


def scan_folders(spark: SparkSession, csv_folder: str, text_folder: str,
                 sample_rows: int | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """``(findings, report)``; a missing folder counts as empty.

    CSV files with the same header are read together as one table.
    """
    files = documents.files_below(spark, csv_folder, "csv")
    by_header: dict[tuple[str, ...], list[str]] = {}
    n_csv = 0
    for row in files.toLocalIterator():
        n_csv += 1
        by_header.setdefault(tuple(documents.csv_header(spark, row["file_path"])), []).append(row["file_path"])
    parts = [scan_csv(spark, paths, sample_rows, **options) for paths in by_header.values()]
    n_txt = 0
    if documents.path_exists(spark, text_folder):
        n_txt = documents.files_below(spark, text_folder, "txt").count()
        if n_txt:
            parts.append(scan_texts(spark, text_folder, **options))
    findings = stack(*parts) if parts else spark.createDataFrame([], FINDINGS)
    report = pd_.scan_summary(findings).select(
        tx.iso_stamp(F.current_timestamp()).alias("scan_date"), F.lit(csv_folder).alias("raw_dir"),
        F.lit(text_folder).alias("docs_dir"), F.lit(n_csv + n_txt).cast("long").alias("files_scanned"),
        "total_findings", "unexpected_pii_found")
    return findings, report


def write_report(findings: DataFrame, report: DataFrame, path: str) -> None:
    """``<path>/report`` is the summary row, ``<path>/findings`` one JSON line per finding."""
    write_json_report(report, f"{path}/report")
    findings.write.mode("overwrite").json(f"{path}/findings")


def nested_report(findings: DataFrame, report: DataFrame) -> DataFrame:
    """The report row with the findings as an array, for a report that is read as one document."""
    nested = findings.agg(F.array_sort(F.collect_list(F.struct(
        "file_path", "column_name", "entity_type", "file_type", "row_count_with_pii", "example_values", "allowed",
        "confidence_min", "confidence_max"))))
    return report.withColumn("findings", nested.scalar())


def gate(report: DataFrame) -> bool:
    """True when nothing unexpected was found."""
    return not report.first()["unexpected_pii_found"]


def require_clean(report: DataFrame) -> None:
    if not gate(report):
        raise UnexpectedPersonalData("the scan found personal data outside the allowed columns")

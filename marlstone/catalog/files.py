"""The file layer: given tables are written to the shared folder as CSV, text and JSON and read back by the public readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.catalog import medallion as raw
from marlstone.catalog import text as t
from marlstone.catalog.base import table
from marlstone.functions import text as tx
from marlstone.functions import vector as vx
from marlstone.operators import chunking, entities
from marlstone.plans import medallion
from marlstone.session import shared_folder, stack
from marlstone.sources import documents, golden, tables
from marlstone.sources.split_csv import csv_records


def _place(spark, name: str = "files") -> str:
    return f"{shared_folder(spark)}/marlstone-staged/{uuid.uuid4().hex}/{name}"


def _write_csv(df: DataFrame, path: str, *by: str) -> str:
    out = df.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).option("emptyValue", "").option("lineSep", "\n")
    (out.partitionBy(*by) if by else out).csv(path)
    return path


def _articles(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("title"), F.col("text").alias("abstract"), F.col("lang").alias("category"))


def csv_documents(spark, sf):
    """Documents as CSV with line breaks inside quotes, read by as many tasks as there are splits."""
    path = _write_csv(_articles(spark, sf), _place(spark, "articles.csv"))
    return documents.csv_documents(spark, path).select("row", "type", "title", "category", F.md5("text").alias("digest"))


def text_documents(spark, sf):
    """One text file for each benchmark passage."""
    path = _place(spark)
    table(spark, sf, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(path)
    read = documents.text_documents(spark, path)
    return read.select(F.regexp_extract("source", r"item_id=(\d+)", 1).cast("long").alias("item_id"), "type", F.md5("text").alias("digest"))


def loaded_documents(spark, sf):
    """CSV and text paths together; a missing one is skipped."""
    csv = _write_csv(_articles(spark, sf), _place(spark, "articles.csv"))
    path = _place(spark)
    table(spark, sf, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(path)
    read = documents.load_documents(spark, [csv, path, f"{path}-missing.txt"])
    return read.groupBy("type").agg(F.count("*").alias("n"), F.count("title").alias("titled"))


def golden_set(spark, sf):
    """Benchmark passages as golden questions in JSON."""
    path = _place(spark)
    text = F.col("text")
    table(spark, sf, "benchmark").select(
        "item_id", F.substring(text, 1, 40).alias("question"), text.alias("ground_truth"), F.array(text).alias("contexts"),
        F.lit("regulation").alias("source")).write.partitionBy("item_id").json(path)
    read = golden.load_golden(spark, path)
    return read.select("question", F.md5("ground_truth").alias("truth"), F.size("contexts").alias("n_contexts"), "source")


def found_files(spark, sf):
    """The folders below a path in which CSV files lie."""
    path = _write_csv(_articles(spark, sf), _place(spark), "category")
    files = documents.files_below(spark, path, "csv")
    return files.select(F.regexp_extract("file_path", "category=([^/]+)", 1).alias("category")).distinct()


def first_csv_rows(spark, sf):
    """The first three rows of a CSV file in parts for each language, in reading order.

    The rows are sorted over all tasks, so a language is a folder of parts whose names
    stand in reading order, and no task writes or reads more than its range.
    """
    kept = table(spark, sf, "documents").select("lang", "doc_id", "text")
    kept = kept.repartitionByRange("lang", "doc_id").sortWithinPartitions("lang", "doc_id")
    path = _write_csv(kept, _place(spark), "lang")
    records = csv_records(spark, path).withColumn("_folder", F.regexp_extract("_file", "lang=([^/]+)", 1))
    first = documents.first_rows_per_file(records, 3, "_folder", F.struct("_file", "_row"))
    row = F.row_number().over(Window.partitionBy("_folder").orderBy("_file", "_row")) - 1  # of the three that are left
    return first.select(F.col("_folder").alias("lang"), row.cast("long").alias("row"),
                        F.col("_record.doc_id").cast("long").alias("doc_id"))


def cached_vectors(spark, sf):
    """Vectors are built once for the same source rows and read the second time."""
    path, source, built = _place(spark), table(spark, sf, "embeddings"), []

    def build(df: DataFrame) -> DataFrame:
        built.append(1)
        return df.select("vec_id", vx.unit("embedding").alias("unit"))

    tables.load_or_build(spark, path, source, ["vec_id"], build)
    again = tables.load_or_build(spark, path, source, ["vec_id"], build)
    return again.select("vec_id", F.size("unit").alias("dim"), F.lit(len(built)).alias("builds"))


def json_report(spark, sf):
    """Shares of labels as a report file."""
    path = _place(spark)
    shares = table(spark, sf, "labels").agg(F.round(F.avg("quality"), 6).alias("quality"), F.round(F.avg("toxic"), 6).alias("toxic"),
                                            F.count("*").alias("n"))
    tables.write_json_report(shares, path)
    return spark.read.schema(shares.schema).json(path)


def run_log(spark, sf):
    """Two runs with different settings in one log, with a stamp in the compact form."""
    path = _place(spark)
    labels = table(spark, sf, "labels")
    for cut, kept in ((0, labels), (1, labels.filter("toxic = 0"))):
        metrics = kept.agg(F.round(F.avg("quality"), 6).alias("score")).select(F.lit("quality").alias("metric"), "score")
        log = tables.append_run(metrics, {"cut": cut}, path)
    stamp = F.col("timestamp").rlike(r"^\d{8}T\d{6}Z$")
    return log.select("cut", F.col("metrics")["quality"].alias("quality"), stamp.alias("stamped"))


def iso_stamps(spark, sf):
    """Order dates as stamps."""
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").cast("timestamp").alias("ts"))
    return orders.select(tx.iso_stamp(F.col("ts")).alias("iso"), tx.compact_stamp(F.col("ts")).alias("compact")).groupBy(
        "iso", "compact").agg(F.count("*").alias("n"))


def stored_chunks(spark, sf):
    """A chunk table is replaced in the catalog, opened and counted."""
    name = f"chunks_{uuid.uuid4().hex}"
    docs = table(spark, sf, "documents").select("doc_id", "text")
    chunks = chunking.with_chunk_id(chunking.chunk_documents(docs, "fixed", size=400, overlap=40))
    tables.create_chunk_index(chunks.limit(0), name)
    tables.create_chunk_index(chunks, name)
    stored, n = tables.open_chunk_index(spark, name)
    return stored.groupBy("doc_id").agg(F.count("*").alias("chunks"), F.max("chunk_pos").alias("last")).withColumn("stored", F.lit(n).cast("long"))


def model_counts(spark, sf):
    """All models are built layer by layer and counted."""
    built = medallion.run_models({"pension_funds": raw.raw_funds(spark, sf), "transactions": raw.raw_transactions(spark, sf),
                                  "articles": raw.raw_articles(spark, sf)})
    return stack(*[df.agg(F.count("*").alias("n")).select(F.lit(name).alias("model"), "n") for name, df in sorted(built.items())
                   if name in ("stg_pension_funds", "stg_transactions", "stg_articles", "dim_funds", "fact_transactions")])


def entity_batch(spark, sf):
    """A preview and the number of entities of every document."""
    out = entities.batch_extract(table(spark, sf, "documents"), phrases=t.LICENCE_PHRASES, patterns={})
    return out.select("doc_id", F.length("preview").alias("preview_length"), F.size("entities").alias("n_entities"))


def entity_terms(spark, sf):
    """Entities of one label only."""
    found = entities.extract_entities(table(spark, sf, "documents"), phrases=t.LICENCE_PHRASES, patterns={}, labels=["TERMS"])
    return found.select("doc_id", "text", "start_char")


QUERIES = {f.__name__: f for f in (
    csv_documents, text_documents, loaded_documents, golden_set, found_files, first_csv_rows, cached_vectors, json_report, run_log,
    iso_stamps, stored_chunks, model_counts, entity_batch, entity_terms)}

SQL = {
    "csv_documents": """
SELECT doc_id AS row, 'article' AS type, source AS title, lang AS category, md5(text) AS digest FROM documents""",
    "text_documents": "SELECT item_id, 'text' AS type, md5(text || chr(10)) AS digest FROM benchmark",
    "loaded_documents": """
SELECT 'article' AS type, count(*) AS n, count(source) AS titled FROM documents
UNION ALL SELECT 'text', count(*), 0 FROM benchmark""",
    "golden_set": """
SELECT substring(text, 1, 40) AS question, md5(text) AS truth, CAST(1 AS INTEGER) AS n_contexts, 'regulation' AS source FROM benchmark""",
    "found_files": "SELECT DISTINCT lang AS category FROM documents",
    "first_csv_rows": """
SELECT lang, n - 1 AS row, doc_id FROM (
  SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents) WHERE n <= 3""",
    "cached_vectors": "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim, CAST(1 AS INTEGER) AS builds FROM embeddings",
    "json_report": "SELECT round(avg(quality), 6) AS quality, round(avg(toxic), 6) AS toxic, count(*) AS n FROM labels",
    "run_log": """
SELECT CAST(0 AS INTEGER) AS cut, round(avg(quality), 6) AS quality, TRUE AS stamped FROM labels
UNION ALL SELECT 1, round(avg(quality), 6), TRUE FROM labels WHERE toxic = 0""",
    "iso_stamps": """
SELECT strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS iso, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS compact,
  count(*) AS n FROM orders GROUP BY ALL""",
    "stored_chunks": """
WITH c AS (SELECT doc_id, CAST(s // 360 AS INTEGER) AS pos FROM (
    SELECT doc_id, text, unnest(range(0, length(text), 360)) AS s FROM documents)
  WHERE regexp_matches(substring(text, s + 1, 400), '\\S'))
SELECT doc_id, count(*) AS chunks, max(pos) AS last, (SELECT count(*) FROM c) AS stored FROM c GROUP BY doc_id""",
    "model_counts": f"""
SELECT 'stg_pension_funds' AS model, count(*) AS n FROM ({raw.SQL['stg_funds']})
UNION ALL SELECT 'stg_transactions', count(*) FROM ({raw.SQL['stg_transactions']})
UNION ALL SELECT 'stg_articles', count(*) FROM ({raw.SQL['stg_articles']})
UNION ALL SELECT 'dim_funds', count(*) FROM ({raw.SQL['dim_funds']})
UNION ALL SELECT 'fact_transactions', count(*) FROM ({raw.SQL['fact_transactions']})""",
    "entity_batch": f"""
WITH {t._ENTITIES}
SELECT d.doc_id, CAST(CASE WHEN length(d.text) > 120 THEN 123 ELSE length(d.text) END AS INTEGER) AS preview_length, CAST(count(e.text) AS INTEGER) AS n_entities
FROM documents d LEFT JOIN entity e ON e.doc_id = d.doc_id GROUP BY d.doc_id, d.text""",
    "entity_terms": f"WITH {t._ENTITIES} SELECT doc_id, text, start_char FROM entity WHERE label = 'TERMS'",
}

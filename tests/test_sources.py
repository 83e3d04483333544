import json
import os

import pytest
from pyspark.sql import functions as F

from marlstone.operators import evaluation as ev
from marlstone.plans import medallion as m
from marlstone.plans import personal_data_scan as scan
from marlstone.sources import documents, golden, seeds, tables


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "raw" / "deep").mkdir(parents=True)
    (tmp_path / "docs").mkdir()
    (tmp_path / "raw" / "articles.csv").write_text(
        '﻿id,title,abstract,category\n7,T7,"two\nlines, quoted",esg\n9,T9,plain,risk\n', encoding="utf-8")
    (tmp_path / "raw" / "deep" / "pay.csv").write_text(
        "who,Analyst_Email,note\nA,a@x.org,call +1 (743) 555-3824\nB,b@x.org,\nC,,mail c@y.org\n")
    (tmp_path / "docs" / "one.txt").write_text("Write to d@z.org or e@z.org on 2024-01-31.")
    (tmp_path / "docs" / "two.txt").write_text("nothing")
    return tmp_path


def test_load_documents(spark, folder):
    paths = [f"{folder}/raw/articles.csv", f"{folder}/docs/one.txt", f"{folder}/missing.txt"]
    got = {(r["type"], r["row"], r["text"], r["title"]) for r in documents.load_documents(spark, paths).collect()}
    assert got == {("article", 7, "two\nlines, quoted", "T7"), ("article", 9, "plain", "T9"),
                   ("text", None, "Write to d@z.org or e@z.org on 2024-01-31.", None)}
    assert documents.load_documents(spark, [f"{folder}/nope.csv"]).count() == 0
    by_row = documents.csv_documents(spark, f"{folder}/raw/deep/pay.csv")
    assert sorted((r["row"], r["text"]) for r in by_row.collect()) == [(0, "A"), (1, "B"), (2, "C")]


def test_files_below(spark, folder):
    names = [os.path.basename(r["file_path"]) for r in documents.files_below(spark, f"{folder}/raw", "csv").collect()]
    assert names == ["articles.csv", "pay.csv"]
    assert documents.files_below(spark, f"{folder}/none", "csv").count() == 0


def test_golden(spark, tmp_path):
    items = [{"question": "q", "ground_truth": "t", "contexts": ["a", "b"], "source": "ips", "extra": 1}]
    (tmp_path / "g.json").write_text(json.dumps(items))
    pairs = ev.golden_pairs(golden.load_golden(spark, f"{tmp_path}/g.json"))
    assert [r["context"] for r in pairs.orderBy("context_pos").collect()] == ["a", "b"]
    (tmp_path / "bad.json").write_text(json.dumps(items + [{"question": "q"}]))
    with pytest.raises(ValueError, match="Item 1 .*(contexts|ground_truth)"):
        golden.load_golden(spark, f"{tmp_path}/bad.json")
    with pytest.raises(FileNotFoundError):
        golden.load_golden(spark, f"{tmp_path}/none.json")


def test_load_or_build(spark, tmp_path):
    calls = []

    def build(df):
        calls.append(1)
        return df.withColumn("n", F.length("t"))

    first = spark.createDataFrame([(1, "a")], "k long, t string")
    for source in (first, first, first.withColumn("t", F.lit("bb"))):
        out = tables.load_or_build(spark, f"{tmp_path}/ix", source, ["k", "t"], build)
    assert len(calls) == 2 and out.first()["n"] == 2
    tables.load_or_build(spark, f"{tmp_path}/ix", first, ["k", "t"], build, rebuild=True)
    assert len(calls) == 3


def test_index_and_warehouse_tables(spark):
    chunks = spark.createDataFrame([("chunk_0_0", "x", [1.0])], "chunk_id string, content string, embedding array<float>")
    tables.create_chunk_index(chunks, "chunks_indexed")
    tables.create_chunk_index(chunks, "chunks_indexed")
    assert tables.open_chunk_index(spark, "chunks_indexed")[1] == 1
    spark.sql("DROP TABLE chunks_indexed")


def test_run_log_and_report(spark, tmp_path):
    metrics = spark.createDataFrame([("faithfulness", 0.9), ("context_recall", 0.5)], "metric string, score double")
    for model in ("m1", "m2"):
        log = tables.append_run(metrics, {"embedding_model": model, "chunk_size": 500}, f"{tmp_path}/runs")
    assert log.count() == 2 and log.first()["metrics"]["context_recall"] == 0.5
    assert len(log.first()["timestamp"]) == 16
    report = {r["metric"]: r["status"] for r in ev.threshold_report(metrics).collect()}
    assert report == {"faithfulness": "PASS", "answer_relevancy": "FAIL", "context_precision": "FAIL",
                      "context_recall": "FAIL"}
    assert ev.mean_of_metrics(metrics).first()["average"] == pytest.approx(0.7)
    assert ev.mean_of_metrics(metrics.limit(0)).first()["average"] == 0.0


def test_no_pairs_gives_null(spark):
    none = spark.createDataFrame([], "query_id long, method string, rank int, content string")
    golden_ = spark.createDataFrame([], "query_id long, context string")
    assert ev.recall_at_k(none, golden_, ["a"]).count() == 0
    some = spark.createDataFrame([(1, "x" * 100)], "query_id long, context string")
    assert ev.recall_at_k(none, some, ["a"]).first()["recall"] == 0.0


def test_prefix_match_counts_shared_beginnings(spark):
    same = "p" * 80
    ranked = spark.createDataFrame([(1, "a", 1, same + "X"), (1, "a", 2, same + "Y")],
                                   "query_id long, method string, rank int, content string")
    golden_ = spark.createDataFrame([(1, same + "Y")], "query_id long, context string")
    assert ev.mrr_at_k(ranked, golden_, ["a"]).first()["mrr"] == 1.0
    assert ev.mrr_at_k(ranked, golden_, ["a"], match="exact").first()["mrr"] == 0.5


def test_scan_folders(spark, folder):
    findings, report = scan.scan_folders(spark, f"{folder}/raw", f"{folder}/docs")
    got = {(os.path.basename(r["file_path"]), r["column_name"], r["entity_type"]):
           (r["row_count_with_pii"], r["allowed"], r["example_values"]) for r in findings.collect()}
    assert got == {
        ("pay.csv", "Analyst_Email", "EMAIL_ADDRESS"): (2, True, ["<EMAIL_ADDRESS>", "<EMAIL_ADDRESS>"]),
        ("pay.csv", "note", "PHONE_NUMBER"): (1, False, ["call <PHONE_NUMBER>"]),
        ("pay.csv", "note", "EMAIL_ADDRESS"): (1, False, ["mail <EMAIL_ADDRESS>"]),
        ("one.txt", None, "EMAIL_ADDRESS"): (2, False, ["Write to <EMAIL_ADDRESS> or e@z.org on ",
                                                        " to d@z.org or <EMAIL_ADDRESS> on 2024-01-31."]),
        ("one.txt", None, "DATE_TIME"): (1, False, [" or e@z.org on <DATE_TIME>."]),
    }
    row = report.first()
    assert (row["files_scanned"], row["total_findings"], row["unexpected_pii_found"]) == (4, 5, True)
    assert not scan.gate(report)
    with pytest.raises(scan.UnexpectedPersonalData):
        scan.require_clean(report)
    scan.write_report(findings, report, f"{folder}/out/report")
    assert spark.read.json(f"{folder}/out/report/findings").count() == 5
    assert len(scan.nested_report(findings, report).first()["findings"]) == 5
    sampled, _ = scan.scan_folders(spark, f"{folder}/raw", f"{folder}/none", sample_rows=1)
    assert sampled.filter("column_name = 'note'").count() == 1
    empty, clean = scan.scan_folders(spark, f"{folder}/none", f"{folder}/none")
    assert empty.count() == 0 and scan.gate(clean)


def test_models(spark):
    raw = {
        "pension_funds": spark.createDataFrame(
            [("f1", " One ", 2020, 90.0, "NL", "FTK"), ("f1", "One", 2021, 130.0, "NL", "FTK"), ("f2", "Two", 2021, -1.0, "BE", "X")],
            "fund_id string, fund_name string, reporting_year int, coverage_ratio_pct double, country string, "
            "regulatory_regime string"),
        "transactions": spark.createDataFrame(
            [(1, "f1", "2021-02-03", 5.0, "a@b.c", "NL1"), (2, "f9", "2999-01-01", 7.0, None, None)],
            "transaction_id long, fund_id string, transaction_date string, amount double, counterparty_email string, "
            "counterparty_iban string"),
        "articles": spark.createDataFrame([(1, "w " * 30), (2, "short"), (3, " ")], "id long, abstract string"),
    }
    built = m.run_models(raw)
    assert {r["fund_id"]: r["coverage_status"] for r in built["dim_funds"].collect()} == {
        "f1": "well_funded", "f2": "underfunded"}
    fact = built["fact_transactions"]
    assert not [c for c in fact.columns if "email" in c or "iban" in c]
    assert fact.filter("fund_id = 'f9'").first()["country"] is None
    assert [r["id"] for r in built["mart_rag_corpus"].collect()] == [1]
    checks = {r["test"]: r["failures"] for r in m.check_models(built).collect()}
    assert checks == {"coverage_ratio_positive": 1, "no_future_transactions": 1}
    assert set(m.run_models(raw, "marts")) == {"dim_funds", "fact_transactions", "mart_rag_corpus"}
    with pytest.raises(ValueError):
        m.run_models(raw, "gold")
    assert seeds.asset_classes(spark).count() == 7
    for name in ("dim_funds", "fact_transactions", "mart_rag_corpus"):
        spark.sql(f"DROP TABLE {name}")


def test_first_rows_are_read_from_parts_of_bounded_size(spark, tmp_path):
    """Every task of the copy and of the reading has its own range of rows; before, a language was one file."""
    from marlstone.catalog import files
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('text ', id, '\n', repeat('x', 50)) as text",
                                        "if(id % 4 = 3, 'fr', 'en') as lang", "'s' as source")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.lang, r.row, r.doc_id) for r in files.first_csv_rows(spark, str(tmp_path)).collect())
    assert got == [("en", 0, 0), ("en", 1, 1), ("en", 2, 2), ("fr", 0, 3), ("fr", 1, 7), ("fr", 2, 11)]
    kept = docs.repartitionByRange(4, "lang", "doc_id").sortWithinPartitions("lang", "doc_id")
    path = files._write_csv(kept, str(tmp_path / "parts"), "lang")
    assert len(os.listdir(os.path.join(path, "lang=en"))) > 2


def test_arrivals_are_as_many_files_as_their_rows_come_in(spark, tmp_path):
    """Two halves and a second version, each one micro-batch; before, a half was one file."""
    from marlstone.catalog import streams
    rows = [(i, f"text {i}" + (" License" if i % 5 == 0 else "")) for i in range(40)] + [(None, "lost")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    repartitioned = []
    real = type(spark.range(1)).repartition
    type(spark.range(1)).repartition = lambda self, *a: repartitioned.append(a) or real(self, *a)
    try:
        index = streams.incremental_index(spark, str(tmp_path)).collect()
    finally:
        type(spark.range(1)).repartition = real
    assert not repartitioned
    assert sorted((r.doc_id, r.version) for r in index) == [(i, 2 if i % 5 == 0 else 1) for i in range(40)]

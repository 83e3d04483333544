"""Literal cases of the column functions."""

import hashlib

from pyspark.sql import functions as F

from marlstone.functions import keys
from marlstone.functions import text as tx
from marlstone.functions import vector as vx
from marlstone.operators import conversations as cv
from marlstone.operators import personal_data as pd_


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_cosine_of_zero_and_unit(spark):
    rows = [([0.0, 0.0], [1.0, 0.0]), ([3.0, 4.0], [3.0, 4.0]), ([1.0, 0.0], [0.0, 2.0])]
    got = one(spark, rows, "a array<float>, b array<float>", vx.cosine("a", "b"), vx.l2_norm(vx.unit("a")))
    assert [round(g[0], 9) for g in got] == [0.0, 1.0, 0.0]
    assert [round(g[1], 6) for g in got] == [0.0, 1.0, 1.0]


def test_ratio_classes(spark):
    rows = [(99.99,), (100.0,), (110.0,), (125.0,), (None,)]
    got = one(spark, rows, "r double", keys.ratio_class(F.col("r")), keys.ratio_class(F.col("r"), "unknown"))
    assert [g[0] for g in got] == ["underfunded", "at_risk", "healthy", "well_funded", "well_funded"]
    assert got[4][1] == "unknown" and got[0][1] == "underfunded"


def test_surrogate_key(spark):
    got = one(spark, [(1, None)], "a int, b string", keys.surrogate_key("a", "b"), keys.surrogate_key("b", "b"))
    null = "_dbt_utils_surrogate_key_null_"
    assert got[0][0] == hashlib.md5(f"1-{null}".encode()).hexdigest()
    assert got[0][1] == hashlib.md5(f"{null}-{null}".encode()).hexdigest()


def test_text_helpers(spark):
    rows = [("chunk_17",), ("chunk_x",), ("plain",)]
    assert [g[0] for g in one(spark, rows, "t string", tx.chunk_number("t"))] == [17, None, None]
    rows = [("\t A b\n c ",), ("",)]
    got = one(spark, rows, "t string", tx.tokens("t"), tx.strip("t"), tx.has_content("t"), tx.token_estimate("t"))
    assert got[0] == (["a", "b", "c"], "A b\n c", True, 4) and got[1] == ([], "", False, 0)


def test_spans_are_offsets(spark):
    rows = [("a1bb22c",), ("none",), ("7",)]
    got = one(spark, rows, "t string", tx.spans("t", r"\d+"))
    assert [[tuple(s) for s in g[0]] for g in got] == [[("1", 1, 2), ("22", 4, 6)], [], [("7", 0, 1)]]


def test_headed_passage(spark):
    got = one(spark, [("s", "Art 1", "x"), (None, None, "y")], "s string, a string, b string",
              tx.headed_passage(F.col("s"), F.col("a"), F.col("b")))
    assert [g[0] for g in got] == ["[s — Art 1]\nx", "[unknown]\ny"]


def test_routes_of_the_examples(spark):
    asked = [
        ("What does IORP III say about the prudent person principle?", "rag_retrieval"),
        ("Show me ABP fund performance for 2023", "sql_query"),
        ("What concepts are referenced by Article 19?", "rag_retrieval"),
        ("What articles are related to the ORSA requirement?", "graph_query"),
        ("I'm confused about ESG reporting, can a human help?", "human_checkpoint"),
        (None, "rag_retrieval"),
    ]
    got = one(spark, asked, "t string, r string", cv.route(F.col("t")), "r")
    assert all(a == b for a, b in got)


def test_message_arguments(spark):
    rows = [("Show nl_pfzw in 2021",), ("fund performance please",), ("tell me",), ("about Risk Appetite of x",)]
    got = one(spark, rows, "t string", cv.fund_id(F.col("t")), cv.asked_year(F.col("t")), cv.asked_entity(F.col("t")))
    assert got[0] == ("NL_PFZW", 2021, "Show")
    assert got[1][0] == "FUND PERFORMANCE" and got[1][1] == 2023
    assert got[2] == ("NL_ABP", 2023, "tell me")
    assert got[3][2] == "Risk Appetite"


def test_iban_and_phone(spark):
    rows = [("NL91ABNA0417164300",), ("NL91ABNA0417164301",), ("NL91 ABNA 0417 1643 00",)]
    assert [g[0] for g in one(spark, rows, "t string", pd_.iban_is_valid(F.col("t")))] == [True, False, True]
    rows = [("card 4465758382889437 end",), ("call +1 (743) 555-3824 now",), ("pay NL91ABNA0417164300.",)]
    got = [g[0] for g in one(spark, rows, "t string", pd_.redact(F.col("t")))]
    assert got == ["card 4465758382889437 end", "call <PHONE_NUMBER> now", "pay <IBAN_CODE>."]


def test_lookup(spark):
    table = {"nl": "Dutch"}
    got = one(spark, [("NL",), ("nl",), ("be",)], "k string", keys.lookup(F.col("k"), table, "none"))
    assert [g[0] for g in got] == ["Dutch", "Dutch", "none"]


def test_findings_read_texts_again_only_for_examples(spark):
    cells = spark.createDataFrame(
        [("f", None, "c", "null a@b.nl"), ("f", 3, "c", "a@b.nl 2020-01-01"), ("f", 3, "c", "A a@b.nl"), ("f", 5, "c", "z@b.nl"),
         ("f", 9, "c", "q@b.nl"), ("f", 1, "d", "nothing"), (None, 1, "c", "a@b.nl"), ("g", None, "c", "x@b.nl")],
        "file_path string, row_pos long, column_name string, value string")
    found = {(r.file_path, r.entity_type): (r.row_count_with_pii, r.example_values) for r in pd_.column_findings(cells).collect()}
    mail = "<EMAIL_ADDRESS>"
    assert found == {("f", "EMAIL_ADDRESS"): (5, [f"null {mail}", f"{mail} 2020-01-01", f"A {mail}"]),
                     ("f", "DATE_TIME"): (1, ["a@b.nl <DATE_TIME>"]), ("g", "EMAIL_ADDRESS"): (1, [mail])}
    counts = pd_.column_counts(cells)
    assert sorted((r.file_path, r.entity_type, r.row_count_with_pii) for r in counts.collect()) == [
        ("f", "DATE_TIME", 1), ("f", "EMAIL_ADDRESS", 5), ("g", "EMAIL_ADDRESS", 1)]
    assert "Join" not in counts._jdf.queryExecution().optimizedPlan().toString()

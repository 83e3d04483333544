"""Search over the stored block index against the full scan."""

import pytest
from pyspark.sql import functions as F

from marlstone.operators import block_index, lexical
from marlstone.operators.block_index import BlockIndex, Search

FOLDER = "/root/testdata/sf0.01"


def rows(df):
    return sorted((r.query_id, r["rank"], r.chunk_id, round(r.score, 6)) for r in df.collect())


@pytest.mark.parametrize("k,bits", [(10, 4), (3, 3), (10, 20)])
def test_equals_the_scan_and_reads_less(spark, tmp_path, k, bits):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(
        F.col("doc_id").alias("chunk_id"), F.col("text").alias("content"), "lang")
    asked = spark.read.parquet(f"{FOLDER}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    block_index.build(docs, near=("lang",), block_bits=bits).save(str(tmp_path / "index"), files=4)
    found = Search(BlockIndex.load(spark, str(tmp_path / "index")), asked, k)
    assert rows(found.hits) == rows(lexical.bm25_search(docs, asked, k))
    read, stored = found.postings_read()
    assert 0 < read and (read < stored or bits == 20)
    if bits == 3:
        assert read < 0.8 * stored


def test_odd_texts(spark):
    texts = [None, "", "a", "a a b", "b c", "c c c c", "a b c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "chunk_id long, content string")
    asked = spark.createDataFrame([(1, "a b a"), (2, "zzz"), (3, None), (4, "c")], "query_id int, text string")
    for bits in (0, 1, 3):
        got = block_index.search(block_index.build(docs, block_bits=bits), asked, 2, first_blocks=1)
        assert rows(got) == rows(lexical.bm25_search(docs, asked, 2))
    assert block_index.search(block_index.build(docs.limit(0)), asked, 2).collect() == []
    assert block_index.search(block_index.build(docs), asked.limit(0), 2).collect() == []


def test_a_bounded_batch_is_scored_in_tasks_and_repeated_ids_by_joins(spark):
    docs = spark.createDataFrame([(i, f"a b{i % 3} " + "c " * (i % 5)) for i in range(60)], "chunk_id long, content string")
    asked = spark.createDataFrame([(1, "a c"), (2, "b1 b1"), (3, "zzz")], "query_id long, text string")
    search = Search(block_index.build(docs, block_bits=2), asked, 4)
    assert "MapInArrow" in search.hits._jdf.queryExecution().optimizedPlan().toString()
    assert rows(search.hits) == rows(lexical.bm25_search(docs, asked, 4))
    twice = docs.union(docs.limit(7)).union(spark.createDataFrame([(None, "a c")], docs.schema))
    got = Search(block_index.build(twice, block_bits=20), asked, 70).hits
    plain = lexical.bm25_scores(lexical.lexical_index(twice), asked)
    assert {(r.query_id, r.chunk_id): round(r.score, 6) for r in got.collect()} == {
        (r.query_id, r.chunk_id): round(r.score, 6) for r in plain.collect()}

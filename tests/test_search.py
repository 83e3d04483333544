"""Both ways of every search must agree, and agree with a plain computation."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marlstone.operators import dense, fusion, lexical
from marlstone.operators.embedding import HashingEmbedder, ModelEmbedder
from marlstone.operators.rerank import CosineScorer, ModelScorer, rerank
from marlstone.plans import retrieval as plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select(
        F.col("doc_id").alias("chunk_id"), F.col("text").alias("content"), "source")


@pytest.fixture(scope="module")
def queries(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_bm25_scan_equals_join(corpus, queries, monkeypatch):
    columns = ("query_id", "rank", "chunk_id", "score")
    for options in ({}, {"variant": "okapi"}, {"pad": True, "k": 250}, {"k1": 0.9, "b": 0.3}):
        scanned = rows(lexical.bm25_search(corpus, queries, **options), *columns)
        with monkeypatch.context() as m:
            m.setattr(lexical, "TERM_BLOCK", 1)
            assert scanned == rows(lexical.bm25_search(corpus, queries, **options), *columns)


def test_bm25_stored_index(spark, corpus, queries, tmp_path):
    lexical.lexical_index(corpus).save(str(tmp_path), 4)
    stored = lexical.LexicalIndex.load(spark, str(tmp_path))
    columns = ("query_id", "rank", "chunk_id", "score")
    assert rows(lexical.bm25_search(corpus, queries, index=stored), *columns) == rows(
        lexical.bm25_search(corpus, queries), *columns)


def test_bm25_by_hand(spark):
    texts = ["a b c", "a a d", "e f"]
    docs = spark.createDataFrame(list(enumerate(texts)), "chunk_id long, content string")
    asked = spark.createDataFrame([(0, "A a zz"), (1, "zz")], "query_id long, text string")
    got = rows(lexical.bm25_search(docs, asked, 5), "query_id", "chunk_id", "score")
    idf = math.log((3 - 2 + 0.5) / (2 + 0.5) + 1)
    part = lambda f, dl: f * 2.5 / (f + 1.5 * (0.25 + 0.75 * dl / (8 / 3)))
    want = [(0, 0, 2 * idf * part(1, 3)), (0, 1, 2 * idf * part(2, 3))]
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want])
    padded = rows(lexical.bm25_search(docs, asked, 2, pad=True), "query_id", "rank", "chunk_id")
    assert padded == [(0, 1, 1), (0, 2, 0), (1, 1, 0), (1, 2, 1)]


def test_keyword_scan_equals_join(corpus, queries, monkeypatch):
    columns = ("query_id", "rank", "chunk_id", "hits")
    scanned = rows(lexical.keyword_search(corpus, queries, 7), *columns)
    monkeypatch.setattr(lexical, "TERM_BLOCK", 1)
    assert scanned == rows(lexical.keyword_search(corpus, queries, 7), *columns)


def test_keyword_is_substring(spark):
    docs = spark.createDataFrame([(0, None, "pensions"), (1, "Fund", "x"), (2, "y", "z")],
                                 "chunk_id long, title string, content string")
    asked = spark.createDataFrame([(0, "pension pension fund")], "query_id long, text string")
    got = rows(lexical.keyword_search(docs, asked, 5, fields=("title", "content")), "rank", "chunk_id", "hits")
    assert got == [(1, 0, 1), (2, 1, 1), (3, 2, 0)]


def test_tiled_equals_broadcast(spark, monkeypatch):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    find = lambda: rows(dense.nearest(vectors, asked, 4, id_col="vec_id", metric="cosine", skip_self=True),
                        "query_id", "rank", "vec_id", "score")
    once = find()
    monkeypatch.setattr(dense, "QUERY_BLOCK", 90)
    monkeypatch.setattr(dense, "TILE_ROWS", 70)
    assert once == find()
    pdf = vectors.toPandas()
    m = np.stack(pdf.embedding).astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(m @ m.T, 9)
    np.fill_diagonal(sims, -9)
    ids = pdf.vec_id.to_numpy()
    want = sorted((ids[q], r + 1, ids[i]) for q in range(len(ids))
                  for r, i in enumerate(np.lexsort((ids, -sims[q]))[:4]))
    assert [w[:3] for w in once] == want


def test_null_vectors_and_ties(spark):
    v = "chunk_id long, embedding array<float>"
    docs = spark.createDataFrame([(3, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (4, [0.0, 1.0])], v)
    asked = spark.createDataFrame([(0, [1.0, 0.0]), (1, None)], "query_id long, embedding array<float>")
    assert rows(dense.nearest(docs, asked, 2), "query_id", "rank", "chunk_id") == [(0, 1, 1), (0, 2, 3)]
    assert dense.nearest(docs.filter("chunk_id > 9"), asked, 2).columns == ["query_id", "chunk_id", "score", "rank"]
    assert dense.nearest(docs.filter("chunk_id > 9"), asked, 2).count() == 0
    assert dense.nearest(docs, asked.filter("query_id > 9"), 2).count() == 0


def test_rrf_keeps_first_seen_order(spark):
    a = spark.createDataFrame([(0, 5, 1), (0, 9, 2)], "query_id long, chunk_id long, rank int")
    b = spark.createDataFrame([(0, 7, 1), (0, 9, 2)], "query_id long, chunk_id long, rank int")
    fused = fusion.reciprocal_rank_fusion(fusion.ranked_union({"a": a, "b": b}))
    assert [(r["chunk_id"], r["rank"]) for r in fused.orderBy("rank").collect()] == [(9, 1), (5, 2), (7, 3)]
    assert abs(fused.filter("chunk_id = 9").first()["score"] - 2 / 62) < 1e-9


def test_models_behind_the_hooks(spark, corpus, queries):
    def load():
        return lambda texts: np.array([[len(t), t.count("e"), 1.0] for t in texts])

    embedder = ModelEmbedder(load, batch=16)
    out = embedder.encode(corpus, "content").select(F.size("embedding").alias("n")).distinct().collect()
    assert [r["n"] for r in out] == [3]
    shortlist = fusion.with_text(lexical.bm25_search(corpus, queries, 6), corpus).join(queries, "query_id")
    scorer = ModelScorer(lambda: lambda pairs: [-len(p[1]) for p in pairs])
    best = rerank(shortlist, scorer, 1)
    shortest = shortlist.groupBy("query_id").agg(F.min(F.length("content")).alias("n"))
    assert best.join(shortest, "query_id").filter(F.length("content") != F.col("n")).count() == 0
    assert rerank(shortlist, CosineScorer(HashingEmbedder(32)), None, min_score=0.99).count() <= shortlist.count()


def test_place_weights(corpus):
    plain = HashingEmbedder(16)
    weighted = plain.fit_weights(corpus, "content")
    assert len(weighted.place_weights) == 16 and min(weighted.place_weights) >= 0
    assert weighted.encode(corpus, "content").filter(F.size("embedding") != 16).count() == 0


def test_hybrid_over_chunks(spark, queries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    config = plan.RetrievalConfig(chunking_strategy="sentence")
    chunks = plan.build_chunks(docs, config)
    got = plan.hybrid_retrieve(chunks, queries, config, columns=("content", "source"))
    assert got.groupBy("query_id").count().filter("count <> 5").count() == 0
    vector_only = plan.RetrievalConfig(use_bm25=False, use_reranking=False)
    assert plan.hybrid_retrieve(chunks, queries, vector_only).count() == 5 * queries.count()


def test_graph_guided_falls_back_to_summaries(spark, queries):
    chunks = spark.createDataFrame([], "chunk_id string, content string, article string, embedding array<float>")
    articles = spark.createDataFrame([("A2", "t2", "s2"), ("A1", "t1", "s1")], "id string, title string, summary string")
    got = plan.graph_guided(chunks, queries, articles, HashingEmbedder(8)).select("context").distinct().collect()
    assert [r["context"] for r in got] == ["[A1] t1\ns1\n\n[A2] t2\ns2"]


def test_nan_vector_is_no_hit(spark):
    rows = [(i, [float(i), 1.0]) for i in range(10)] + [(99, [float("nan"), 1.0])]
    corpus = spark.createDataFrame(rows, "chunk_id long, embedding array<double>").coalesce(1)
    asked = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<double>")
    assert [r.chunk_id for r in dense.nearest(corpus, asked, 3).orderBy("rank").collect()] == [9, 8, 7]


def test_null_texts_count_alike_on_both_ways(spark):
    corpus = spark.createDataFrame([("a", "red fox"), ("b", "blue"), ("c", None), ("d", None)], "chunk_id string, content string")
    asked = spark.createDataFrame([("q", "red fox")], "query_id string, text string")
    scan = lexical.bm25_search(corpus, asked, 3).collect()
    stored = lexical.bm25_search(corpus, asked, 3, index=lexical.lexical_index(corpus)).collect()
    assert [(r.chunk_id, r.score) for r in scan] == [(r.chunk_id, r.score) for r in stored]


def test_more_than_twenty_holders(spark):
    """Every document that holds a passage is found, however many there are."""
    from marlstone.operators import evaluation

    passage = "a passage that many documents share " * 4
    docs = [(f"d{i}", f"{i} words before {passage} and after") for i in range(30)]
    docs += [("other", "nothing of the kind"), ("short", passage[:40]), ("none", None), ("empty", "")]
    corpus = spark.createDataFrame(docs, "chunk_id string, content string")
    golden = spark.createDataFrame([(1, passage), (2, "not in any text at all"), (3, None)], "query_id long, context string")
    got = sorted(tuple(r) for r in evaluation.holders(corpus, golden).collect())
    want = corpus.crossJoin(golden).filter(evaluation.is_relevant(F.col("content"), F.col("context")))
    assert got == sorted(tuple(r) for r in want.select("query_id", "chunk_id").collect())
    assert len([c for q, c in got if q == 1]) == 32


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_queries_of_the_same_terms_are_scored_once(spark, corpus, monkeypatch):
    """More queries than a batch may have, but few that differ: no join on the terms."""
    asked = spark.createDataFrame([(f"{w}_{i}", w) for i in range(20) for w in ("the le", "le THE", "der", "zzz", None)],
                                  "query_id string, text string")
    columns = ("query_id", "rank", "chunk_id", "score")
    want = rows(lexical.bm25_search(corpus, asked, 3, pad=True), *columns)
    monkeypatch.setattr(lexical, "QUERY_BLOCK", 4)
    found = lexical.bm25_search(corpus, asked, 3, pad=True)
    assert "MapInArrow" in _plan(found) and rows(found, *columns) == want
    monkeypatch.setattr(lexical, "BAG_BLOCK", 1)
    assert rows(lexical.bm25_search(corpus, asked, 3, pad=True), *columns) == want


def test_every_score_needs_no_shuffle_and_merges_repeated_ids(spark, corpus, queries):
    columns = ("query_id", "chunk_id", "score")
    again = spark.createDataFrame([(1, "the le la"), (1, "the le la"), (1, "the"), (None, "le"), (None, "le la"), (2, None)],
                                  "chunk_id long, content string")
    for docs in (corpus.select("chunk_id", "content"), corpus.select("chunk_id", "content").union(again), corpus.limit(0)):
        plain = lexical.bm25_scores(lexical.lexical_index(docs), queries).withColumn("score", F.round("score", 9))
        keyed = lambda df: {(r.query_id, r.chunk_id): r.score for r in df.collect()}
        want, got = keyed(plain), lexical.every_score(docs, queries)
        assert tuple(got.columns) == columns and keyed(got) == pytest.approx(want, abs=2e-9)
    assert "Aggregate" not in _plan(lexical.every_score(corpus, queries))


def test_a_scan_holds_few_entries_at_a_time(monkeypatch):
    import pyarrow as pa

    from marlstone.operators import scan
    monkeypatch.setattr(scan, "LIST_ENTRIES", 10)
    lists = [[1] * n for n in (3, 3, 3, 3, 25, 0, 1)] + [None]
    batch = pa.record_batch([pa.array(range(8)), pa.array(lists, pa.list_(pa.int64()))], names=["id", "l"])
    parts = [p.column(0).to_pylist() for p in scan.parts_of(batch, 3)]
    assert parts == [[0, 1, 2], [3], [4], [5, 6, 7]]


def test_large_tables_meet_in_few_tiles(spark):
    """The vectors are copied once per block of 32,768 queries and not once per 4,096."""
    assert dense.TILE_QUERIES >= 8 * dense.QUERY_BLOCK and dense.TILE_ROWS >= 200_000


@pytest.mark.parametrize("cosine", [True, False])
@pytest.mark.parametrize("skip_self", [True, False])
def test_nearest_rows_equal_a_sort(monkeypatch, cosine, skip_self):
    """Blocks of a few rows and queries, equal vectors, repeated ids, null vectors and entries that are no numbers."""
    monkeypatch.setattr(dense, "ROWS_AT_ONCE", 7)
    monkeypatch.setattr(dense, "QUERIES_AT_ONCE", 3)
    monkeypatch.setattr(dense, "ROWS_READY", 20)
    rng = np.random.default_rng(4)
    vectors = rng.integers(-2, 3, (90, 3)).astype(np.float32)
    vectors[5, 0] = np.nan
    asked, ids, query_ids = rng.integers(-2, 3, (11, 3)).astype(float), rng.integers(0, 60, 90), np.arange(11)
    some = pa.array([None if i % 9 == 0 else v.tolist() for i, v in enumerate(vectors)], pa.list_(pa.float32()))
    best = dense.NearestRows(query_ids, asked, 4, cosine, skip_self)
    for at in range(0, 90, 40):
        best.offer(ids[at:at + 40], some.slice(at, 40))
    unit = dense._unit if cosine else lambda m: m
    scores = np.round(unit(asked) @ unit(vectors.astype(float)).T, 9)
    want = []
    for q in query_ids:
        hits = sorted((-scores[q, i], ids[i]) for i in range(90) if i % 9 and i != 5 and not (skip_self and ids[i] == q))
        want += [(q, i, -s) for s, i in hits[:4]]
    got = best.table(pa.schema([("query_id", pa.int64()), ("chunk_id", pa.int64()), ("score", pa.float64())]))
    assert [tuple(r.values()) for r in got.to_pylist()] == want


def test_whole_texts_are_hashed_by_different_words(spark):
    """Their vectors are those of the places counted on the JVM side, at its blanks and in its lower case."""
    texts = ["a  b a\tA\x0bİΣ ß\x1cq ", " \r\n", "", None, "é\x0cÉ 😀", "x " * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    for weights in (None, [float(i % 5) for i in range(16)]):
        e = HashingEmbedder(16, weights)
        got = e.encode(df, "t", normalise=False)
        assert "md5" not in got._jdf.queryExecution().executedPlan().toString()
        for r in got.select("t", "embedding", e.places(F.col("t")).alias("p")).collect():
            counts = np.bincount(r["p"] or [], minlength=16).astype(float)
            assert r["embedding"] == (counts if weights is None else counts * weights).tolist()

import numpy as np
from pyspark.sql import functions as F

from marlstone.operators import chunking, profile


def test_pca_equals_numpy(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding")
    pdf = vectors.toPandas().sort_values("vec_id")
    m = np.stack(pdf.embedding).astype(float)
    m -= m.mean(axis=0)
    _, s, vt = np.linalg.svd(m, full_matrices=False)
    axes = vt[:2] * np.sign(vt[:2][np.arange(2), np.abs(vt[:2]).argmax(axis=1)])[:, None]
    got = profile.pca(vectors, "vec_id").toPandas().sort_values("vec_id")
    assert np.allclose(got[["pc1", "pc2"]], m @ axes.T, atol=1e-6)
    share = s**2 / (s**2).sum()
    assert np.allclose(got[["explained1", "explained2"]].iloc[0], share[:2], atol=1e-9)


def test_parents_keep_best_child_rank(spark):
    children = spark.createDataFrame([("c1", "p1"), ("c2", "p1"), ("c3", "p2"), ("c4", "p3")],
                                     "chunk_id string, parent_id string")
    parents = spark.createDataFrame([("p1", "one"), ("p2", "two"), ("p3", "three")], "parent_id string, content string")
    hits = spark.createDataFrame([(0, "c2", 1), (0, "c3", 2), (0, "c1", 3), (1, "c1", 1)],
                                 "query_id long, chunk_id string, rank int")
    got = chunking.parents_of_hits(hits, children, parents).orderBy("query_id", "rank")
    assert [(r["query_id"], r["rank"], r["parent_content"]) for r in got.collect()] == [
        (0, 1, "one"), (0, 2, "two"), (1, 1, "one")]


def test_packing_keeps_numbers_and_budget(spark):
    docs = spark.createDataFrame([("s", 1, "aa"), ("s", 2, None), ("s", 3, "cccc")], "g string, pos long, t string")
    row = profile.pack_context(docs, "t", "pos", "g", first_n=3, budget=100).first()
    assert row["context"] == "Article 1: aa\n\nArticle 3: cccc"
    assert profile.pack_context(docs, "t", "pos", "g", first_n=3, budget=5).first()["context"] == "Artic"
    fitting = profile.fitting_texts(docs, F.coalesce(F.length("t"), F.lit(0)), "pos", "g", 3)
    assert [r["pos"] for r in fitting.orderBy("pos").collect()] == [1, 2]


def test_texts_of_no_size_use_up_nothing(spark):
    rows = [("a", i, 0) for i in range(50)] + [("a", 100, 3), ("a", 101, None), ("a", 102, 2), ("a", 103, 0), ("a", 104, 1), ("a", 105, 0)]
    rows += [("b", 1, 9), ("b", 2, 0), (None, 1, 0), (None, 2, 5)]
    df = spark.createDataFrame(rows, "g string, at int, n int")
    got = {(r.g, r.at): r.running_size for r in profile.fitting_texts(df, F.col("n"), "at", "g", 5).collect()}
    assert got == {**{("a", i): 0 for i in range(50)}, ("a", 100): 3, ("a", 101): 3, ("a", 102): 5, ("a", 103): 5, (None, 1): 0, (None, 2): 5}

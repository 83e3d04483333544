import random

import pytest
from pyspark.sql import functions as F

from marlstone.operators import chunking as ch


def texts(df):
    return [r["content"] for r in df.orderBy("doc_id", "chunk_pos").collect()]


def docs(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")


def test_fixed(spark):
    assert texts(ch.chunk_fixed(docs(spark, "abcdefgh", "", "     "), 5, 2)) == ["abcde", "defgh", "gh"]
    with pytest.raises(ValueError):
        ch.chunk_fixed(docs(spark, "a"), 5, 5)


def test_fixed_equals_plain_loop(spark):
    body = "".join(random.Random(1).choice("ab \n") for _ in range(997))
    want, start = [], 0
    while start < len(body):
        want.append(body[start:start + 50])
        start += 43
    assert texts(ch.chunk_fixed(docs(spark, body), 50, 7)) == [w for w in want if w.strip()]


def test_sentence_keeps_long_sentence_whole(spark):
    got = texts(ch.chunk_sentence(docs(spark, "Aa. Bb. " + "c" * 30 + ". Dd."), 10))
    assert got == ["Aa. Bb.", "c" * 30 + ".", "Dd."]


def _check_pieces(body, pieces, size, overlap):
    for piece in pieces:
        assert piece in body
        assert len(piece) <= size or not any(s in piece[1:] for s in ("\n\n", "\n", ". ", " "))
    at = 0
    for piece in pieces:
        begin = body.index(piece, max(0, at - overlap - 2))
        assert body[at:begin].strip() == ""
        at = begin + len(piece)
    assert body[at:].strip() == ""


@pytest.mark.parametrize("seed", range(20))
def test_recursive_covers_the_text(seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 9))) + str(i) for i in range(300)]
    body = words[0] + "".join(rnd.choice([" ", " ", " ", ". ", "\n", "\n\n"]) + w for w in words[1:])
    _check_pieces(body, ch.split_recursive(body, 80, 20, ch.SEPARATORS), 80, 20)
    _check_pieces(body, ch.split_recursive(body, 120, 0, ch.PARENT_SEPARATORS), 120, 0)


def test_recursive_hard_split():
    assert ch.split_recursive("x" * 25, 10, 0, ch.SEPARATORS) == ["x" * 10, "x" * 10, "x" * 5]
    assert ch.split_recursive("x" * 25, 10, 0, ch.PARENT_SEPARATORS) == ["x" * 25]


def test_markdown_sections_and_fallback(spark):
    body = "intro\n# One\ntext\n## Two\n\nmore\n#### no header\n### Three"
    got = ch.chunk_markdown(docs(spark, body, "plain text without headers"))
    assert texts(got) == ["# One\ntext", "## Two\n\nmore\n#### no header", "### Three", "plain text without headers"]
    assert {r["chunk_strategy"] for r in got.collect()} == {"markdown", "recursive"}
    kept = ch.chunk_markdown(docs(spark, body), keep_preamble=True)
    assert texts(kept)[0] == "intro"


def test_semantic_breaks_where_words_change(spark):
    got = texts(ch.chunk_semantic(docs(spark, "red red red. red red red. blue blue blue.", "Only one."), 0.5))
    assert got == ["red red red. red red red.", "blue blue blue.", "Only one."]


def test_parent_child_ids(spark):
    body = " ".join(f"word{i}" for i in range(600))
    children, parents = ch.chunk_parent_child(docs(spark, body, body))
    assert parents.select("parent_id").distinct().count() == parents.count()
    whole = parents.select("parent_id", F.col("content").alias("parent"))
    lost = children.join(whole, "parent_id").filter(~F.contains("parent", "content"))
    assert lost.count() == 0 and children.filter(F.length("content") > 200).count() == 0


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="fixed"):
        ch.chunk_documents(docs(spark, "a"), "nope")


def test_recursive_pieces_are_cut_a_few_texts_at_a_time(spark, monkeypatch):
    texts = [None, "", "a b", "x" * 9, "one two. three\n\nfour"] * 7
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(ch, "TEXTS_AT_ONCE", 2)
    got = sorted((r.doc_id, r.chunk_pos, r.content) for r in ch.chunk_recursive(docs, 6, 2).collect())
    want = [(i, n, p) for i, t in enumerate(texts) for n, p in enumerate(ch.split_recursive(t, 6, 2, ch.SEPARATORS) if t else [])]
    assert got == sorted(want)

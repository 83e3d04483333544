"""All five stages on small tables, against plain versions of what each keeps."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marlstone.llm import contamination, language, mixing
from marlstone.llm.common import table
from tests.llm.test_simhash import brute_print
from tests.llm.brute import components

FOLDER = "/root/testdata/sf0.001"


def crc(tokenizer, text):
    ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    return len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())


def test_run_against_plain_stages(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    extra = spark.createDataFrame([(900001, None, "en", "s", 0), (900002, "12 34 !", "en", "s", 7), (900003, "the same words again", None, None, 20),
                                   (900004, "the same words again", "de", "t", 20)], docs.schema)
    docs.unionByName(extra).withColumns({"_h": F.lit("x"), "copies": F.lit(7)}).write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, FOLDER, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = {r.doc_id: r for r in table(spark, str(tmp_path), "documents").collect()}

    kept = {i: r for i, r in rows.items() if language.has_letter(r.text)}
    prints = {i: brute_print(r.text) for i, r in kept.items()}
    ids = sorted(kept)
    edges = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = components(ids, edges)
    kept = {i: kept[i] for i in ids if roots[i] == i}
    assert 900003 in kept and 900004 not in kept and 900001 not in kept and 900002 not in kept
    hit = {r.doc_id for r in contamination.find_overlaps(
        spark.createDataFrame(list(kept.values()), table(spark, str(tmp_path), "documents").schema), table(spark, FOLDER, "benchmark")).collect()}
    assert hit
    kept = {i: r for i, r in kept.items() if i not in hit}
    left = spark.createDataFrame(list(kept.values()), table(spark, str(tmp_path), "documents").schema)
    want = Counter({r.doc_id: r.copies for r in mixing.copies(left).collect() if r.copies})

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in got) == want
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER)), 0
    known = {i: crc(tokenizer, kept[i].text or "") for i in want}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, *known[r.doc_id])
        start += r.n_tokens
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_without_rows(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, FOLDER, "benchmark").limit(0).write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

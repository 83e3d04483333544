"""Token files: exact ids, exact round trips, damage found."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marlstone.llm import tokens
from marlstone.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " \n\t", "It's I'LL don't 'd  x'S", "a<|endoftext|>b", "é İstanbul ΣΣ ẞ", "x\x1cy\x85z\xa0w\xadv",
       "日本語 テスト", "A1b22 !!'s -- '' \"\"", "ǅ ª º ¼ ½", "  padded   text ", "🙂 emoji 👩‍👩‍👧", "ﬁ ﬀ", "word " * 50000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_library(spark, library):
    texts = [r.text for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()] + ODD
    texts += ["".join(map(chr, range(a, a + 64))) for a in range(32, 0x250, 64)]
    own = tokens.Encoder(PATH)
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(own.encode(text), own.type).tolist() == found.ids


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 32768, 32769, 150001])
def test_round_trip_of_a_frame(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 5000)
    shared = tokens.Table.of_counts(np.bincount(ids, minlength=6000) if n else np.ones(6000))
    assert shared.freq.sum() == 1 << tokens.BITS
    data, symbols = tokens.pack(ids, shared), shared.symbols()
    assert (tokens.unpack(data, n, shared, symbols) == ids).all()
    if n > tokens.BLOCK:  # from a checkpoint
        assert (tokens.unpack(data, n, shared, symbols, 1, 2) == ids[tokens.BLOCK:2 * tokens.BLOCK]).all()
    if n:
        bad = bytearray(data)
        bad[len(bad) // 2] ^= 1
        with pytest.raises(ValueError):
            tokens.unpack(bytes(bad), n, shared, symbols)


def test_extreme_tables():
    for counts in ([5], [1, 10 ** 12], [1] * 40000 + [10 ** 9]):
        shared = tokens.Table.of_counts(np.array(counts))
        assert shared.freq.sum() == 1 << tokens.BITS and (shared.freq > 0).all()
        ids = np.arange(len(counts)) if len(counts) > 1 else np.zeros(70000, int)
        assert (tokens.unpack(tokens.pack(ids, shared), len(ids), shared, shared.symbols()) == ids).all()
    with pytest.raises(ValueError):
        tokens.Table.of_counts(np.ones((1 << 20) + 1))


def expected(library, rows):
    coded = []
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        coded.append((doc is not None, doc or 0, zlib.crc32(ids.tobytes()), doc, len(ids)))
    out, start = [], 0
    for _, _, crc, doc, n in sorted(coded, key=lambda r: r[:3]):
        out.append((doc, start, n, crc))
        start += n
    return out


def test_files(spark, library):
    rows = [(i * 7 % 50, t) for i, t in enumerate(ODD)] + [(None, "no id"), (None, None), (3, "again"), (3, "again"), (99, None)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, start int, ids string")
    got = sorted(map(tuple, tokens.write_and_read(df, PATH).collect()), key=lambda r: r[1])
    want = expected(library, rows)
    assert [r[1:3] for r in got][0] == want[0][1:3] and len(got) == len(want)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert tokens.write_and_read(df.limit(0), PATH).count() == 0


def test_documents(spark, library):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = sorted(map(tuple, tokens.write_and_read(docs, PATH).collect()))
    assert got == sorted(expected(library, [(r.doc_id, r.text) for r in docs.collect()]))


def test_an_unknown_word_costs_no_look_at_the_known_ones():
    """A text with one new word codes that word alone; the others come from the cache in one go."""
    from marlstone.llm import tokens
    coded = []
    cache = tokens.Cache(lambda w: coded.append(w) or w.encode())
    looked = []
    get = cache.get
    cache.get = lambda key: looked.append(key) or get(key)
    assert cache.join(["a", "b", "a", ""]) == b"aba"
    assert cache.join(["a", "c", "b", ""]) == b"acb"
    assert sorted(coded) == ["", "a", "b", "c"] and not looked


def test_a_worker_holds_each_string_once_in_two_generations(spark, library, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 50)
    own = tokens.Encoder(PATH)
    texts = [f"only{'abcdefghij'[i % 10]}{chr(97 + i // 26)}{chr(97 + i % 26)}, word{i}" for i in range(600)]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(own.encode(text), own.type).tolist() == found.ids
    caches = [c for c in vars(own).values() if isinstance(c, tokens.Cache)]
    assert sum(len(c.young) + len(c.old) for c in caches) <= 2 * (50 + 10)  # a text adds no more than ten


def test_texts_are_coded_a_few_at_a_time(spark):
    from pyspark.sql import functions as F

    docs = spark.range(0, 700, 1, 1).select(F.expr("nullif(id, -1) as doc_id"), F.concat(F.lit("text "), "id").alias("text"))

    def sizes(parts):
        import pyarrow as pa
        for part in parts:
            yield pa.record_batch([pa.array([part.num_rows])], names=["n"])

    whole = docs.select("doc_id", F.repeat(F.lit("word "), 4000).alias("text"))  # 14 MB
    assert tokens.token_ids(docs, PATH).where("counts is null").count() == 700
    got = [r.n for r in whole.mapInArrow(sizes, "n long").collect()]
    assert sum(got) == 700 and max(got) < 400


def test_each_word_of_a_text_is_looked_up_once_also_beside_a_new_one():
    looked = []

    class Word(str):
        def __hash__(self):
            looked.append(str(self))
            return str.__hash__(self)

    cache = tokens.Cache(lambda w: w.encode())
    assert cache.join(["a", "b"]) == b"ab"
    assert cache.join([Word("a"), Word("b"), "new"]) == b"abnew"
    assert looked == ["a", "b"]


def test_words_with_a_mark_or_digit_at_their_end(library):
    own = tokens.Encoder(PATH)
    for word in ("it'", "it's", "word.", "été,", "x1", "x_", "a", ".", "1", "''", "don't.", "naïve!!", "ªº", "ǆ-", "a­", "a<|", "<|x|>"):
        for text in (word, f"{word} {word}"):
            assert np.frombuffer(own.encode(text), own.type).tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_piece_that_many_texts_say_is_looked_up_once_for_all_of_them(library):
    import pyarrow as pa

    own = tokens.Encoder(PATH)
    looked, each = [], own.coded.each
    own.coded.each = lambda keys: looked.extend(keys) or each(keys)
    texts = ["Some words, some", None, "", " words\tsome words!", "it's some", "日本 some"] * 20
    got = [np.frombuffer(r, own.type).tolist() for r in own.encode_all(pa.array(["skipped", *texts]).slice(1))]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sorted(k for k in looked if k) == sorted({"some", "words", ",", "!", "it", "'s"})
    assert own.encode_all(pa.array([], pa.string())) == [] and own.encode_all(pa.array([None, "", " "], pa.string())) == [b""] * 3


def test_every_character_is_cut_as_the_library_cuts_it_beside_others(library):
    import pyarrow as pa

    own = tokens.Encoder(PATH)
    texts = [t for c in map(chr, range(1, 0x251)) for t in (f"a{c}b 1{c}2 !{c}? _{c}_ '{c} {c}'s {c}", f"é{c}{c}", f"{c}'ll{c}")]
    for text, got in zip(texts, own.encode_all(pa.array(texts))):
        assert np.frombuffer(got, own.type).tolist() == library.encode(text, add_special_tokens=False).ids, text

"""SimHash near duplicates by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments (22, 21, 21 bits), each padded
to a word of the Golay code and decoded to the indices of nearby code words: one
to six keys per segment, and two segments that differ in at most two bits share
one of them.

``links`` finds all pairs of fingerprints with two or fewer differing bits. Two
errors leave one of three segments whole (pigeonhole), and the next segment holds
two at most, so the pair meets under that whole segment with one of the next
segment's keys: 34 bits, about 16 keys per fingerprint. A key with many
fingerprints is not paired out: its members differ outside the whole segment
only, so each is entered under itself and under every fingerprint one bit away
there. Two members within two bits share such an entry, and all that share one are
within two bits, so each is linked with the smallest: exact, and linear.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm import golay
from marlstone.llm.common import byte_words, hashed, join_safe, shingles, text_key
from marlstone.llm.components import components
from marlstone.session import bounded_batches, stack, staged

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and number of bits
PAIRED = 64  # larger keys are linked by the exact linear way


def fingerprint(tokens: list[bytes], size: int) -> int:
    """A bit is 1 if more than half of the shingles' hashes have it; no words: 0. Signed 64 bits."""
    return _majority(hashed(shingles(tokens, size)))


def _majority(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = 3, key: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``key`` columns, ``fingerprint`` (long) and ``n_shingles`` of every text; a null text has no words."""
    bounded_batches(docs.sparkSession)
    kept = docs.select(*key, "text")
    schema = kept.drop("text").schema.add("fingerprint", "long").add("n_shingles", "long")

    def run(parts):
        for part in parts:
            tokens = (byte_words(t.as_py()) for t in part.column(len(key)))
            found = [(fingerprint(t, size), max(len(t) - size + 1, min(len(t), 1))) for t in tokens]
            values = np.array(found, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:len(key)], pa.array(values[:, 0]), pa.array(values[:, 1])],
                names=[*key, "fingerprint", "n_shingles"])

    return kept.mapInArrow(run, schema)


def _segments(prints: np.ndarray) -> list[np.ndarray]:
    return [(prints >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]


def _segment_keys(parts):
    """Per whole segment: its bits with each key of the next segment."""
    for part in parts:
        prints = part.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        segments = _segments(prints)
        for i in range(3):
            found = golay.keys(segments[(i + 1) % 3]).astype(np.int64)
            key = segments[i][:, None] << 14 | np.where(found < 0, 0, found) << 2 | i
            row, _ = np.nonzero(found >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[found >= 0]), pa.array(prints.view(np.int64)[row]),
                 pa.array(np.full(len(row), i, np.int32))], names=["key", "fingerprint", "whole"])


def _flips(parts):
    """Every fingerprint under itself and under those one bit away outside the whole segment."""
    for part in parts:
        prints = part.column(0).to_numpy(zero_copy_only=False)
        whole = part.column(1).to_numpy(zero_copy_only=False)
        for i, (at, n) in enumerate(SEGMENTS):
            own = prints[whole == i].view(np.uint64)
            if len(own):
                bits = [0, *(1 << b for b in range(64) if not at <= b < at + n)]
                entry = own[:, None] ^ np.array(bits, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(entry.reshape(-1).view(np.int64)), pa.array(np.repeat(own, len(bits)).view(np.int64))],
                    names=["entry", "fingerprint"])


def links(prints: DataFrame, paired: int = PAIRED) -> DataFrame:
    """``u, v``: links that connect all distinct ``fingerprint`` values with two or fewer differing bits.

    Fingerprints under one key are paired up to ``paired`` of them and linked through
    shared one-bit neighbours beyond; both are exact, and every link is itself
    within two bits.
    """
    keyed = prints.select("fingerprint").distinct().mapInArrow(
        _segment_keys, "key long, fingerprint long, whole int")
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = staged(keyed.join(counts, "key"))
    few = shared.where(F.col("n") <= paired).select("key", "fingerprint")
    pairs = (few.select("key", F.col("fingerprint").alias("u"))
             .join(few.select("key", F.col("fingerprint").alias("v")), "key")
             .where("u < v and bit_count(u ^ v) <= 2").select("u", "v"))
    entries = (shared.where(F.col("n") > paired).select("fingerprint", "whole").distinct()
               .mapInArrow(_flips, "entry long, fingerprint long"))
    least = entries.groupBy("entry").agg(F.min("fingerprint").alias("u"), F.count("*").alias("n")).where("n > 1")
    stars = (entries.join(least, "entry").where("fingerprint <> u")
             .select("u", F.col("fingerprint").alias("v")))
    return stack(pairs, stars).distinct()


def _roots(prints: DataFrame, paired: int) -> DataFrame:
    """``fingerprint, root`` of every distinct fingerprint; a fingerprint without a link is its own root."""
    own = prints.select("fingerprint").distinct()
    linked = components(links(prints, paired)).withColumnRenamed("node", "fingerprint")
    return own.join(linked, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))


def simhash_components(docs: DataFrame, size: int = 3, paired: int = PAIRED) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null and
    empty texts have fingerprint 0 and link like any other. ``component_id`` is the
    smallest ``doc_id`` that can be reached; a component of null ids has null.
    Repeated rows are repeated in the result; an empty table gives none.
    """
    prints = staged(fingerprints(docs, size).select("doc_id", "fingerprint"))
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    rooted = least.join(_roots(prints, paired), "fingerprint")
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(of_root, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, size: int = 3, paired: int = PAIRED) -> DataFrame:
    """``docs`` with one document left of each component: that of the smallest ``doc_id`` (null ids last, then by text hash).

    Columns stay as they are, whatever their names. Null and empty texts are one
    component; of rows alike in id and text one stays. Only keys and fingerprints
    are grouped; texts meet the keys of the documents that go, and those of rows
    alike, which are shuffled if there are any.
    """
    key = ["doc_id", "_h", "_g"]
    prints = staged(fingerprints(docs.select("doc_id", *text_key(F.col("text")), "text"), size, tuple(key)).drop("n_shingles"))
    keys = prints.groupBy(*key, "fingerprint").agg(F.count("*").alias("n"))
    keyed = staged(keys.join(_roots(prints, paired), "fingerprint").select(
        "root", "n", F.struct(F.col("doc_id").isNull().alias("none"), *key).alias("k")))
    least = keyed.groupBy("root").agg(F.min("k").alias("least"))
    placed = staged(keyed.join(least, "root").select("k.*", "n", (F.col("k") == F.col("least")).alias("stays")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", *text_key(F.col("text")))
    left = join_safe(rows, placed.where("not stays").select(*key), key, "left_anti")
    alike = placed.where("stays and n > 1").select(*key)
    if alike.isEmpty():
        return left.select("row.*")
    once = join_safe(left, alike, key, "left_anti")
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1)))  # one row of each is kept before the shuffle
    several = join_safe(left, alike, key, "left_semi").withColumn("place", place).where("place = 1")
    return stack(once.select("row.*"), several.select("row.*"))

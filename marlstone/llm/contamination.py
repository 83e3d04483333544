"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a window of words; masked positions are ignored, so a
substituted word there does not hide the window. The hashes of all windows of the
benchmark under all masks are looked up by every window of every document, and each
hit is verified: along its diagonal, a stretch counts as an overlap if it has at least
``MATCHED`` equal words and they are at least ``IDENTITY`` of it. The best-scoring
stretch (a substitution costs ``PENALTY``) is taken if it does; if not, the one with
the most equal words among all stretches that do.

The benchmark is the stated query set and is taken in blocks of bounded size: one
block is sent to all tasks, and the documents are scanned once per block (one
block holds some thousand items). No text of a document leaves its row, so a passage
that a third of all documents share costs nothing extra.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.common import byte_words, hashed
from marlstone.session import bounded_batches, stack, staged

# A passage of 15 words with any two substituted is met by at least one of these (a test tries all).
MASKS = ("11011111", "1100011111", "110100011011")
MATCHED, IDENTITY, PENALTY = 10, 0.8, 2
BLOCK_WORDS = 200_000  # words of the benchmark per block
PIECE_WORDS, PIECE_OVERLAP = 8192, 64  # longer items are cut, pieces overlapping
EDGE = b".,;:!?\"'()[]{}"
_ODD = (np.arange(1, 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_hashes(text: str | None) -> np.ndarray:
    """A hash per word, A-Z lower-cased and without punctuation around it."""
    return hashed([w for w in (w.strip(EDGE) for w in byte_words(text)) if w])


def seed_hashes(words: np.ndarray, number: int) -> np.ndarray:
    """The hash of every window under mask ``number``."""
    mask = MASKS[number]
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, number + 1, dtype=np.uint64) * _ODD[0]
    for at, kept in enumerate(mask):
        if kept == "1":
            total = (total ^ words[at:at + n]) * _ODD[at + 1]
            total ^= total >> np.uint64(29)
    return total


class Block:
    """The seeds of a bounded number of benchmark words, sorted by hash."""

    def __init__(self, items: list[tuple[object, int, np.ndarray]]):
        self.items = items
        keys, owners, places = [], [], []
        for i, (_, _, words) in enumerate(items):
            for number in range(len(MASKS)):
                found = seed_hashes(words, number)
                keys.append(found)
                owners.append(np.full(len(found), i, dtype=np.int32))
                places.append(np.arange(len(found), dtype=np.int32))
        keys = np.concatenate([*keys, np.zeros(0, np.uint64)])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.owners = np.concatenate([*owners, np.zeros(0, np.int32)])[order]
        self.places = np.concatenate([*places, np.zeros(0, np.int32)])[order]
        self.known = np.zeros(1 << 20, dtype=bool)  # a quick look before the search
        self.known[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def overlaps(self, words: np.ndarray):
        """``item, item_start, start, length, matched`` of every verified overlap, one per item piece and diagonal."""
        lines = set()
        for number in range(len(MASKS)):
            found = seed_hashes(words, number)
            at = np.nonzero(self.known[(found >> np.uint64(44)).astype(np.int64)])[0]
            left, right = (np.searchsorted(self.keys, found[at], side) for side in ("left", "right"))
            hit = right > left
            for place, a, b in zip(at[hit], left[hit], right[hit]):
                lines.update(zip(self.owners[a:b].tolist(), (place - self.places[a:b]).tolist()))
        for owner, shift in sorted(lines):
            item, offset, own = self.items[owner]
            first = max(0, shift)
            last = min(len(words), shift + len(own))
            equal = words[first:last] == own[first - shift:last - shift]
            score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -PENALTY))])
            low = np.minimum.accumulate(score)
            end = int(np.argmax(score - low))
            begin = int(np.argmax(score[:end + 1] == low[end]))
            matched = int(equal[begin:end].sum())
            if matched < MATCHED or matched < IDENTITY * (end - begin):
                begin, end = _most_equal(equal)
                matched = int(equal[begin:end].sum())
            if matched >= MATCHED:
                yield item, offset + first - shift + begin, first + begin, end - begin, matched


def _most_equal(equal: np.ndarray) -> tuple[int, int]:
    """Begin and end of the stretch with the most equal words among all in which they are at least ``IDENTITY``.

    With a substitution at ``IDENTITY / (1 - IDENTITY)`` these are the stretches of a score
    from 0 on; for each end the first begin that is not above it has the most words.
    """
    cost = round(IDENTITY / (1 - IDENTITY))
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -cost))])
    count = np.concatenate([[0], np.cumsum(equal)])
    begins = np.searchsorted(-np.minimum.accumulate(score), -score)
    end = int(np.argmax(count - count[begins]))
    inside = np.nonzero(equal[begins[end]:end])[0]
    return (int(begins[end] + inside[0]), int(begins[end] + inside[-1]) + 1) if len(inside) else (0, 0)


def _pieces(benchmark: DataFrame) -> DataFrame:
    kept = benchmark.select("item_id", "text")
    schema = kept.select("item_id").schema.add("offset", "long").add("words", T.ArrayType(T.LongType()))

    def run(parts):
        for part in parts:
            rows = []
            for item, text in zip(*part.columns):
                words = word_hashes(text.as_py())
                for at in range(0, max(1, len(words) - PIECE_OVERLAP), PIECE_WORDS - PIECE_OVERLAP):
                    rows.append((item.as_py(), at, words[at:at + PIECE_WORDS].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], part.schema[0].type), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["item_id", "offset", "words"])

    return kept.mapInArrow(run, schema)


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """The benchmark in blocks of about ``block_words`` words; only one is on the driver at a time."""
    pieces = staged(_pieces(benchmark))
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    count = -(-total // block_words)
    for number in range(count):
        here = F.pmod(F.xxhash64("item_id", "offset"), F.lit(count)) == number
        rows = pieces.where(here).orderBy("item_id", "offset").collect()
        yield Block([(r.item_id, r.offset, np.array(r.words, dtype=np.int64).view(np.uint64)) for r in rows])


def find_overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, item_id, n_overlaps`` and the longest overlap: ``matched, length, start, item_start`` (in words).

    One row per document id and benchmark item that share an overlap. ``docs`` needs
    ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``; other columns are
    ignored. Null and empty texts and items of fewer words than a seed have no overlaps;
    rows of one ``doc_id`` (null too) are counted together; an empty table gives no rows.
    """
    schema = T.StructType([docs.schema["doc_id"], benchmark.schema["item_id"],
                           *[T.StructField(c, T.LongType()) for c in ("item_start", "start", "length", "matched")]])
    kind = {f.name: f for f in schema}

    def scan(block):
        def run(parts):
            for part in parts:
                rows = [(doc.as_py(), *found) for doc, text in zip(*part.columns)
                        for found in block.overlaps(word_hashes(text.as_py()))]
                cols = list(zip(*rows)) if rows else [()] * 6
                types = [part.schema[0].type, pa.string() if isinstance(kind["item_id"].dataType, T.StringType) else pa.int64(),
                         *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=schema.names)
        return docs.select("doc_id", "text").mapInArrow(run, schema)

    bounded_batches(docs.sparkSession)
    found = [scan(b) for b in blocks(benchmark, block_words)]
    rows = stack(*found) if found else docs.sparkSession.createDataFrame([], schema)
    best = F.max(F.struct("matched", (-F.col("length")).alias("length"), (-F.col("start")).alias("start"),
                          (-F.col("item_start")).alias("item_start")))
    return rows.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_overlaps"), best.alias("best")).select(
        "doc_id", "item_id", "n_overlaps", "best.matched", (-F.col("best.length")).alias("length"),
        (-F.col("best.start")).alias("start"), (-F.col("best.item_start")).alias("item_start"))


def without_overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that share no overlap with the benchmark; columns stay as they are. Nothing is shuffled."""
    def keep(block, at):
        def run(parts):
            for part in parts:
                clean = [next(block.overlaps(word_hashes(t.as_py())), None) is None for t in part.column(at)]
                yield part.filter(pa.array(clean, pa.bool_()))
        return run

    bounded_batches(docs.sparkSession)
    for block in blocks(benchmark, block_words):
        docs = docs.mapInArrow(keep(block, docs.columns.index("text")), docs.schema)
    return docs

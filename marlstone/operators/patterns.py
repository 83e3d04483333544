"""Many texts searched in many texts.

Two exact ways. Up to ``PATTERNS`` needles of ``CHARACTERS`` characters in all go into
one automaton, built once in each task, and every haystack is read once in linear
time. A larger needle table becomes a join: each needle is named by the hash of
its first ``2 ** i`` characters, a haystack sends only the places whose rolling hash
may be that of some needle (a filter of fixed size), with the part of the needles'
length, and equal parts meet.

Neither way moves a haystack: rows that are shuffled hold keys and needles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PATTERNS = 200_000
CHARACTERS = 4_000_000
FILTER_BITS = 27  # 16 MB
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


class Finder:
    """An automaton over distinct non-empty needles; values are their places in the list."""

    def __init__(self, needles: Iterable[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.empty = True
        for i, needle in enumerate(needles):
            if needle:
                self.automaton.add_word(needle, i)
                self.empty = False
        if not self.empty:
            self.automaton.make_automaton()

    def inside(self, text: str | None) -> set[int]:
        """Places of the needles that occur in a text."""
        if self.empty or not text:
            return set()
        return {i for _, i in self.automaton.iter(text)}

    def spans(self, text: str | None) -> Iterator[tuple[int, int]]:
        """(end, place) of every occurrence, in order of their ends; ``end`` is the place after the last character."""
        if not self.empty and text:
            for last, i in self.automaton.iter(text):
                yield last + 1, i


def bounded_needles(needles: DataFrame, needle: str, patterns: int = PATTERNS, characters: int = CHARACTERS) -> list[str] | None:
    """The distinct non-empty needles, or None if they are more than one automaton may hold."""
    wanted = needles.select(F.col(needle).alias("_needle")).filter(F.length("_needle") > 0).distinct()
    n, size = wanted.agg(F.count("*"), F.coalesce(F.sum(F.length("_needle")), F.lit(0))).first()
    if n > patterns or size > characters:
        return None
    return sorted(r[0] for r in wanted.collect())


def contained(haystacks: DataFrame, keys: list[str], hay: str, needles: DataFrame, needle: str, *,
              patterns: int = PATTERNS, characters: int = CHARACTERS) -> DataFrame:
    """``keys`` and ``needle``: the distinct pairs of a haystack's key and a needle that occurs in its text ``hay``.

    Comparison is by character, in exact case. Null texts and null or empty needles
    give no pairs.
    """
    lists = contained_lists(haystacks, keys, hay, needles, needle, patterns=patterns, characters=characters)
    return lists.withColumn(needle, F.explode(needle)).distinct()


def contained_lists(haystacks: DataFrame, keys: list[str], hay: str, needles: DataFrame, needle: str, *,
                    patterns: int = PATTERNS, characters: int = CHARACTERS) -> DataFrame:
    """The pairs of ``contained`` with the needles of a haystack in arrays, in one row or several of its key."""
    texts = haystacks.select(*keys, F.col(hay).alias("_hay")).filter(F.col("_hay").isNotNull())
    some = bounded_needles(needles, needle, patterns, characters)
    schema = T.StructType([*texts.schema.fields[:-1], T.StructField(needle, T.ArrayType(T.StringType()))])
    if some is not None:
        return texts.mapInArrow(_scan(some, schema.names), schema)
    return _joined(texts, keys, needles, needle).withColumn(needle, F.array(needle))


def _scan(needles: list[str], names: list[str]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, values = Finder(needles), pa.array(needles, pa.string())
        for part in parts:
            coded = part.column(part.num_columns - 1).dictionary_encode()  # equal texts are read once
            hits = [np.fromiter(finder.inside(t), np.int64) for t in coded.dictionary.to_pylist()]
            code = coded.indices.to_numpy(zero_copy_only=False)
            row = np.flatnonzero(np.array([len(h) for h in hits], np.int64)[code])
            found = [hits[c] for c in code[row]]
            ends = np.cumsum([0] + [len(h) for h in found], dtype=np.int32)
            place = np.concatenate([*found, np.zeros(0, np.int64)])
            kept = [c.take(pa.array(row)) for c in part.columns[:-1]]
            lists = pa.ListArray.from_arrays(pa.array(ends), values.take(pa.array(place)))
            yield pa.RecordBatch.from_arrays([*kept, lists], names=names)
    return run


def rolling(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every window of ``size`` characters, mixed so that all bits count."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    window = codes.astype(np.uint64) + np.uint64(1)
    step, base = 1, _BASE
    while step < size:  # windows of 2 * step from two of step; sizes are powers of two
        window = window[:-step] * base + window[step:]
        base = base * base
        step *= 2
    mixed = window ^ window >> np.uint64(31)
    mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ mixed >> np.uint64(29)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _anchor_size(length: int) -> int:
    return 1 << length.bit_length() - 1


def _anchors(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for part in parts:
            texts = part.column(0).to_pylist()
            sizes = [_anchor_size(len(t)) for t in texts]
            keys = [int(rolling(_codes(t[:s]), s)[0]) for t, s in zip(texts, sizes)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int32()), pa.array([len(t) for t in texts], pa.int32()),
                 pa.array(np.array(keys, np.uint64).view(np.int64))], names=["needle", "size", "length", "anchor"])


def _bits(anchors: DataFrame) -> np.ndarray:
    """A filter of ``2 ** FILTER_BITS`` bits with one bit for each anchor, put together word by word.

    What reaches the driver is bounded by the filter's size, whatever the number of needles.
    """
    bit = F.expr(f"shiftrightunsigned(anchor, {64 - FILTER_BITS})")
    words = anchors.select(F.shiftrightunsigned(bit, 6).alias("word"), F.expr("1L").alias("one"), bit.alias("bit")).select(
        "word", F.expr("shiftleft(one, cast(bit & 63 as int))").alias("mask"))
    out = np.zeros(1 << FILTER_BITS - 6, dtype=np.int64)
    for r in words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toLocalIterator():
        out[r.word] = r["mask"]
    return out.view(np.uint64)


def _joined(texts: DataFrame, keys: list[str], needles: DataFrame, needle: str) -> DataFrame:
    wanted = needles.select(F.col(needle).alias("needle")).filter(F.length("needle") > 0).distinct()
    anchors = wanted.mapInArrow(_anchors, "needle string, size int, length int, anchor long")
    lengths = {s: sorted(n) for s, n in anchors.groupBy("size").agg(F.collect_set("length")).collect()}
    parts = texts.mapInArrow(_parts(lengths, _bits(anchors), [*keys, "needle"]),
                             T.StructType([*texts.schema.fields[:-1], T.StructField("needle", T.StringType())]))
    found = parts.distinct().join(wanted, "needle", "left_semi")
    return found.select(*keys, F.col("needle").alias(needle))


def _parts(lengths: dict[int, list[int]], bits: np.ndarray, names: list[str]):
    """Parts of each text that start where a needle may start and have the length of some needle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                rows, parts = [], []
                for row, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                    codes, seen = _codes(text), set()
                    for size, some in lengths.items():
                        bit = rolling(codes, size) >> np.uint64(64 - FILTER_BITS)
                        known = bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)
                        for at in np.flatnonzero(known).tolist():
                            seen.update(text[at:at + n] for n in some if at + n <= len(text))
                    rows += [row] * len(seen)
                    parts += seen
                kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(parts, pa.string())], names=names)
    return run

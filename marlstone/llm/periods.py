"""Periodic runs of words, found by convolutions of blocks at dyadic scales.

A run is a stretch of words with smallest period ``q`` and at least
``max(LEAST, POWER * q)`` words that no neighbouring word extends keeping ``q``.

Scale ``L = 1, 2, 4, ...`` finds the periods from ``L`` to ``2 L - 1``. The words
are cut into blocks of ``L``. The sum of squared differences between a block and
the words ``d`` further on, for all ``d`` of the scale at once, is

    sum(block ** 2) + sum(window ** 2) - 2 * correlation(block, window)

and the correlation is an exact number-theoretic transform modulo enough primes
that a sum is zero only if it is zero modulo each. Zeros are the places at which
the block occurs again. A run of the scale holds several neighbouring blocks that
all recur at its period, so such rows of blocks, and only they, are extended word
by word to both sides, by less than a block each.

Two exact tests spare blocks the transform: each word of a recurring block occurs
again within ``2 L - 1`` words, and inside a known run of smaller period ``q`` a
block of more than ``q`` words recurs at multiples of ``q`` only, which is that
same run again.

Documents are put end to end, up to ``CHUNK`` words at a time (one document may
be longer), so that short ones share the calls; nothing is found across an end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.common import words

LEAST = 6
POWER = 4
CHUNK = 1 << 16
#: Elements of one batch of transforms.
BATCH = 1 << 18
#: Primes c * 2 ** k + 1 below 2 ** 31 with a generator of their multiplicative group.
PRIMES = ((2013265921, 31), (469762049, 3), (998244353, 3))

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
RUN_TYPE = pa.list_(pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")]))


@lru_cache(maxsize=64)
def _twiddles(prime: int, generator: int, size: int, inverse: bool) -> tuple[np.ndarray, ...]:
    """Powers of the root of unity of each stage, half a stage long, the largest stage first."""
    out = []
    while size > 1:
        root = pow(generator, (prime - 1) // size, prime)
        root = pow(root, prime - 2, prime) if inverse else root
        powers = np.ones(1, dtype=np.uint64)
        step = root
        while len(powers) < size // 2:  # doubled: w**0..w**(k-1), then the same times w**k
            powers = np.concatenate([powers, powers * np.uint64(pow(root, len(powers), prime)) % np.uint64(prime)])
        out.append(powers[:size // 2])
        size //= 2
    return tuple(out)


def _less(x: np.ndarray, prime: np.uint64) -> np.ndarray:
    """Values below twice the prime, reduced; what wraps around is larger."""
    return np.minimum(x, x - prime)


def transform(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Forward transform of every row, its results in the order that ``back`` expects."""
    rows, size = x.shape
    p = np.uint64(prime)
    for w in _twiddles(prime, generator, size, False):
        half = len(w)
        x = x.reshape(rows, -1, 2, half)
        u, v = x[:, :, 0], x[:, :, 1]
        x = np.stack([_less(u + v, p), (u + (p - v)) * w % p], axis=2)
    return x.reshape(rows, size)


def back(x: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Undoes ``transform`` for every row."""
    rows, size = x.shape
    p = np.uint64(prime)
    for w in reversed(_twiddles(prime, generator, size, True)):
        x = x.reshape(rows, -1, 2, len(w))
        u, v = x[:, :, 0], x[:, :, 1] * w % p
        x = np.stack([_less(u + v, p), _less(u + (p - v), p)], axis=2)
    return x.reshape(rows, size) * np.uint64(pow(size, prime - 2, prime)) % p


def recurrences(codes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """For blocks of ``size`` words at ``starts``: a row of flags, one for each distance from ``size`` to ``2 size - 1``.

    ``codes`` must reach ``3 * size - 1`` words beyond every start.
    """
    width = 2 * size
    window = codes[starts[:, None] + np.arange(size, 3 * size)[None, :]]
    window[:, -1] = 0  # the last word is beyond every distance
    block = np.zeros_like(window)
    block[:, :size] = codes[starts[:, None] + np.arange(size)[None, :]]
    largest = int(codes.max(initial=0))
    bound, modulus, zero = 2 * size * largest * largest, 1, None
    squares = np.zeros((len(starts), width + 1), dtype=np.uint64)
    np.cumsum(window * window, axis=1, out=squares[:, 1:])
    ends = squares[:, size:width] - squares[:, :size]
    total = (block * block).sum(axis=1, dtype=np.uint64)[:, None] + ends
    for prime, generator in PRIMES:
        p = np.uint64(prime)
        reversed_block = np.roll(block[:, ::-1] % p, 1, axis=1)  # index -i
        product = transform(window % p, prime, generator) * transform(reversed_block, prime, generator) % p
        twice = back(product, prime, generator)[:, :size] * np.uint64(2) % p
        here = total % p == twice
        zero = here if zero is None else zero & here
        modulus *= prime
        if modulus > bound:
            return zero
    raise ValueError("a block and its codes are too large for the primes")


def _next_same(codes: np.ndarray, doc_of: np.ndarray) -> np.ndarray:
    """Distance to the next equal word of the same document; 2**62 without one."""
    order = np.lexsort((codes, doc_of))
    gap = np.full(len(codes), 1 << 62, dtype=np.int64)
    same = (codes[order[1:]] == codes[order[:-1]]) & (doc_of[order[1:]] == doc_of[order[:-1]])
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return gap


def _extend(codes: np.ndarray, at: np.ndarray, apart: np.ndarray, limit: np.ndarray, size: int, step: int) -> np.ndarray:
    """How many words from ``at`` on, in direction ``step``, equal those ``apart`` further on; fewer than ``size`` each."""
    out = np.empty(len(at), dtype=np.int64)
    per = max(1, BATCH // size)
    for k in range(0, len(at), per):
        a, d, lim = at[k:k + per, None], apart[k:k + per, None], limit[k:k + per, None]
        offset = np.arange(size)[None, :]
        inside = offset < lim
        here = np.where(inside, a + step * offset, 0)
        equal = inside & (codes[here] == codes[np.where(inside, here + d, 0)])
        out[k:k + per] = np.where(equal.all(axis=1), size, np.argmin(equal, axis=1))
    return out


def runs_of(codes: np.ndarray, lengths: np.ndarray, least: int = LEAST, power: int = POWER) -> list[np.ndarray]:
    """Runs (start, length, period) of documents that lie end to end, by start then period, one array for each.

    ``codes`` are equal for equal words of a document; ``power`` must be at least 4.
    """
    n = len(codes)
    ends = np.cumsum(lengths)
    doc_of = np.repeat(np.arange(len(lengths)), lengths)
    end_of = np.repeat(ends, lengths)
    start_of = end_of - np.repeat(lengths, lengths)
    gap = _next_same(codes, doc_of)
    longest = int(lengths.max(initial=0))
    found = np.empty((0, 3), dtype=np.int64)
    size = 1
    while power * size <= longest:
        padded = np.concatenate([codes, np.zeros(3 * size, dtype=codes.dtype)]).astype(np.uint64)
        count = n // size
        starts = np.arange(count) * size
        far = gap[:count * size].reshape(count, size).max(axis=1)
        room = end_of[starts] - starts  # words from the block's start to the document's end
        fits = (room >= 2 * size) & (far < 2 * size)
        known = np.zeros(count, dtype=np.int64)  # end of the last known run that holds the whole block
        for s, length, _ in found[found[:, 1] >= 2 * size]:
            first, last = -(-s // size), (s + length) // size
            known[first:last] = np.maximum(known[first:last], s + length)
        starts = starts[fits & (known < starts + 3 * size - 1)]
        pairs = []
        per = max(1, BATCH // (2 * size))
        for k in range(0, len(starts), per):
            part = starts[k:k + per]
            b, d = np.nonzero(recurrences(padded, part, size))
            pairs.append(np.stack([part[b], d + size], axis=1))
        if pairs:
            found = np.concatenate([found, _grown(padded, np.concatenate(pairs), size, known, end_of, start_of, least, power)])
        size *= 2
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    if len(found):  # one stretch has one smallest period
        new = np.ones(len(found), dtype=bool)
        new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
        found = found[new]
        found = found[np.lexsort((found[:, 2], found[:, 0]))]
    cuts = np.searchsorted(found[:, 0], ends)
    out = [found[a:b] - [s, 0, 0] for a, b, s in zip([0, *cuts[:-1]], cuts, ends - lengths)]
    return out


def _grown(codes, pairs, size, known, end_of, start_of, least, power) -> np.ndarray:
    """Runs from recurrences (block start, distance) of one scale."""
    block, apart = pairs[:, 0], pairs[:, 1]
    inside = block + size + apart
    keep = (inside <= end_of[block]) & (inside > known[block // size])
    block, apart = block[keep], apart[keep]
    if not len(block):
        return np.empty((0, 3), dtype=np.int64)
    order = np.lexsort((block, apart))
    block, apart = block[order], apart[order]
    new = np.ones(len(block), dtype=bool)
    new[1:] = (apart[1:] != apart[:-1]) | (block[1:] != block[:-1] + size) | (start_of[block[1:]] != start_of[block[:-1]])
    at = np.flatnonzero(new)
    many = np.diff([*at, len(block)])
    first, last, apart = block[at], block[at] + many * size, apart[at]
    # a stretch of (power - 1) * d equal words holds at least so many whole blocks
    enough = many >= ((power - 1) * apart - size + 1) // size
    first, last, apart = first[enough], last[enough], apart[enough]
    left = _extend(codes, first - 1, apart, first - start_of[first], size, -1) if len(first) else first
    right = _extend(codes, last, apart, end_of[first] - last - apart, size, 1) if len(first) else first
    start, length = first - left, last + right - first + left + apart
    whole = length >= np.maximum(least, power * apart)
    return np.stack([start, length, apart], axis=1)[whole].astype(np.int64)


def _coded(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of every text, and all of them as numbers from 1 that count anew in each text."""
    tokens = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    codes: list[int] = []
    for row in tokens:
        seen: dict[bytes, int] = {}
        codes.extend([seen.setdefault(w, len(seen) + 1) for w in row])
    return tokens, np.array(codes, dtype=np.int64), np.array([len(r) for r in tokens], dtype=np.int64)


def kept(tokens: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that are in no run beyond its first period."""
    if not len(runs):
        return tokens
    ends = np.zeros(len(tokens) + 1, dtype=np.int64)
    np.add.at(ends, runs[:, 0] + runs[:, 2], 1)
    np.add.at(ends, runs[:, 0] + runs[:, 1], -1)
    return [tokens[i] for i in np.flatnonzero(np.cumsum(ends[:-1]) == 0)]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Slices of at most about ``CHUNK`` words (six characters each); a longer text is a slice of its own."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if held and held + size > 6 * CHUNK:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(texts):
        yield first, len(texts)


def _scan(least: int, power: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column("text").to_pylist()
            for a, b in _chunks(texts):
                tokens, codes, lengths = _coded(texts[a:b])
                all_runs = runs_of(codes, lengths, least, power)
                every = np.concatenate(all_runs)
                offsets = np.cumsum([0, *map(len, all_runs)])
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(every[:, k]) for k in range(3)], fields=list(RUN_TYPE.value_type)))
                collapsed = [b" ".join(kept(t, r)).decode("utf-8", "surrogatepass") for t, r in zip(tokens, all_runs)]
                yield pa.record_batch([part.column("doc_id").slice(a, b - a), pa.array(lengths), lists.cast(RUN_TYPE),
                                       pa.array(collapsed, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])
    return run


def find_runs(docs: DataFrame, least: int = LEAST, power: int = POWER) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    ``runs`` is an array of (start, length, period), words numbered from 0, by
    start then period. ``collapsed`` has the words that are in no run beyond its
    first ``period`` words, joined by a blank. A null or empty text has no words,
    no runs and an empty ``collapsed``; repeated rows are rows of their own.
    Texts are read whole and rows are never moved between tasks.
    """
    if power < 4:
        raise ValueError("runs of fewer than four periods need more blocks than the scales look at")
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(_scan(least, power), schema)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: a tenth of the texts, by the id's crc32, becomes periodic from some word on.

    With h = crc32 of the id as text and g = h div 10, texts with h % 10 = 0 have
    every word i >= a = g % n replaced by word a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8).
    Texts of rows without an id or without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    row = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words(F.col("text"))).alias("w"))
    n = F.size("w").cast("long")
    g = F.floor(F.col("h") / 10).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")

    def word(x: Column, i: Column) -> Column:
        moved = F.when(i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i)
        return F.get("w", moved.cast("int"))

    planted = row.withColumns({"a": F.when(n > 0, a), "p": F.when(n > 0, p)})
    text = F.when(F.col("a").isNotNull(), F.array_join(F.transform("w", word), " ")).otherwise(F.col("text"))
    return planted.select("doc_id", text.alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The number of runs, the longest one (ties: smallest start, then period) and digests of runs and kept words."""
    key = F.transform("runs", lambda r: F.struct((-r.length).alias("minus"), r.start.alias("start"), r.period.alias("period")))
    best = F.array_min(key)
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n"))))
    row = found.withColumn("best", best)
    length = -F.col("best.minus")
    return row.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"),
                      F.col("best.period").alias("period"),
                      F.floor(length * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
                      F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                      F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))

"""Text to vectors.

``HashingEmbedder`` needs no model: each token is hashed to one of ``dim``
places and NumPy counts the places. A task cuts some megabytes of whole texts into
words at a time and hashes each different one once; sentences are hashed on the JVM side.
``ModelEmbedder`` puts a given model behind the same interface; the model is
made once per Python worker and sees whole batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions import text as tx

VECTOR = T.ArrayType(T.FloatType())
SIMILARITIES = T.ArrayType(T.DoubleType())
# Rows whose places are counted at one time inside a task.
ROWS_AT_ONCE = 256
# Bytes of text, beyond a single row, whose words are made distinct at one time inside a task, and their rows times places.
TEXT_BYTES = 8 << 20
CELLS = 1 << 20


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.einsum("ij,ij->i", matrix, matrix, dtype=np.float64))
    size[size == 0] = 1.0
    return matrix / size[:, None]


def _lengths(lists: pa.ListArray) -> np.ndarray:
    counts = lists.value_lengths().to_numpy(zero_copy_only=False)
    return np.nan_to_num(counts).astype(np.int64)


def _vectors(matrix: np.ndarray) -> pa.ListArray:
    rows, dim = matrix.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * dim)
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.astype(np.float32).ravel()))


def _neighbours(matrix: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Cosine of each row with the row before it in its list; null for the first of a list."""
    matrix = matrix.astype(np.float64)
    sims = np.zeros(len(matrix))
    if len(matrix) > 1:
        size = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
        sims[1:] = np.einsum("ij,ij->i", matrix[1:], matrix[:-1]) / (size[1:] * size[:-1] + 1e-9)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    first = np.zeros(len(matrix), dtype=bool)
    first[offsets[:-1][counts > 0]] = True
    values = pa.array(sims, mask=first)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _word_places(words: pa.Array, dim: int) -> np.ndarray:
    texts = words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    digests = b"".join([md5(w).digest() for w in texts])
    return np.frombuffer(digests, ">u2")[::8].astype(np.int64) % dim


def _text_counts(texts: pa.Array, dim: int) -> np.ndarray:
    """How many words of each text have each place; the blanks are those of the JVM."""
    words = pc.ascii_split_whitespace(texts)
    row = np.repeat(np.arange(len(texts)), _lengths(words))
    coded = words.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    said = (pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0)[code]
    place = _word_places(coded.dictionary, dim)[code]
    return np.bincount((row * dim + place)[said], minlength=len(texts) * dim).reshape(len(texts), dim)


def _text_parts(texts: pa.Array, rows: int) -> Iterator[pa.Array]:
    """Slices of at most ``rows`` rows and, beyond a single row, ``TEXT_BYTES``."""
    ends = np.cumsum(np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False)).astype(np.int64))
    at = 0
    while at < len(texts):
        start = ends[at - 1] if at else 0
        last = max(at + 1, min(at + rows, int(np.searchsorted(ends, start + TEXT_BYTES, "right"))))
        yield texts.slice(at, last - at)
        at = last


class Embedder:
    """What retrieval and chunking need from a text encoder."""

    def vector(self, text: Column, normalise: bool = True) -> Column:
        """The vector of a text column."""
        raise NotImplementedError

    def neighbour_similarity(self, sentences: Column) -> Column:
        """For an array of sentences: cosine with the sentence before, null for the first."""
        raise NotImplementedError

    def encode(self, df: DataFrame, text: str, out: str = "embedding", normalise: bool = True) -> DataFrame:
        return df.withColumn(out, self.vector(F.col(text), normalise))


class HashingEmbedder(Embedder):
    """Bag of hashed tokens; the place of a token is the first 16 bits of its md5 modulo ``dim``."""

    def __init__(self, dim: int = 64, place_weights: list[float] | None = None):
        if not 0 < dim <= 65536:
            raise ValueError("dim must be between 1 and 65536")
        if place_weights is not None and len(place_weights) != dim:
            raise ValueError("one weight per place is needed")
        self.dim = dim
        self.place_weights = place_weights

    def places(self, text: Column) -> Column:
        return F.transform(
            tx.tokens(text),
            lambda t: (F.conv(F.substring(F.md5(t), 1, 4), 16, 10).cast("int") % self.dim))

    def _counts(self) -> Callable[[pa.ListArray], np.ndarray]:
        dim, weights = self.dim, self.place_weights

        def count(lists: pa.ListArray) -> np.ndarray:
            matrix = np.zeros((len(lists), dim))
            for at in range(0, len(lists), ROWS_AT_ONCE):
                part = lists.slice(at, ROWS_AT_ONCE)
                rows = np.repeat(np.arange(len(part)), _lengths(part))
                flat = part.flatten().to_numpy(zero_copy_only=False)
                matrix[at:at + len(part)] = np.bincount(rows * dim + flat, minlength=len(part) * dim).reshape(len(part), dim)
            return matrix if weights is None else matrix * np.asarray(weights)

        return count

    def vector(self, text: Column, normalise: bool = True) -> Column:
        dim, weights = self.dim, self.place_weights

        @F.arrow_udf(VECTOR)
        def embed(texts: pa.Array) -> pa.Array:
            matrix, at = np.zeros((len(texts), dim)), 0
            for part in _text_parts(texts, max(ROWS_AT_ONCE, CELLS // dim)):
                matrix[at:at + len(part)] = _text_counts(part, dim)
                at += len(part)
            matrix = matrix if weights is None else matrix * np.asarray(weights)
            return _vectors(_unit_rows(matrix) if normalise else matrix)

        return embed(F.lower(text))

    def neighbour_similarity(self, sentences: Column) -> Column:
        count = self._counts()

        @F.arrow_udf(SIMILARITIES)
        def similarity(lists: pa.Array) -> pa.Array:
            return _neighbours(count(lists.flatten()), _lengths(lists))

        return similarity(F.transform(sentences, self.places))

    def fit_weights(self, df: DataFrame, text: str) -> "HashingEmbedder":
        """Weight each place by ``ln((n + 1) / (df + 1))``; ``dim`` numbers come to the driver."""
        seen = df.select(F.array_distinct(self.places(F.col(text))).alias("p"))
        n = seen.count()
        rows = seen.select(F.explode("p").alias("p")).groupBy("p").count().collect()
        df_of = {r["p"]: r["count"] for r in rows}
        weights = [float(np.log((n + 1) / (df_of.get(i, 0) + 1))) for i in range(self.dim)]
        return HashingEmbedder(self.dim, weights)


class ModelEmbedder(Embedder):
    """A supplied model: ``load()`` returns ``encode(list of texts) -> (n, dim) array``."""

    def __init__(self, load: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = 32,
                 query_prefix: str = ""):
        self.load = load
        self.batch = batch
        self.query_prefix = query_prefix

    def _encode_all(self, model, texts: list[str]) -> np.ndarray:
        parts = [np.asarray(model(texts[i:i + self.batch])) for i in range(0, len(texts), self.batch)]
        return np.concatenate(parts) if parts else np.zeros((0, 1))

    def vector(self, text: Column, normalise: bool = True) -> Column:
        load, encode = self.load, self._encode_all

        @F.arrow_udf(VECTOR)
        def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = load()
            for batch in batches:
                matrix = encode(model, batch.to_pylist())
                yield _vectors(_unit_rows(matrix) if normalise else matrix)

        return embed(F.coalesce(text, F.lit("")))

    def neighbour_similarity(self, sentences: Column) -> Column:
        load, encode = self.load, self._encode_all

        @F.arrow_udf(SIMILARITIES)
        def similarity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = load()
            for batch in batches:
                yield _neighbours(encode(model, batch.flatten().to_pylist()), _lengths(batch))

        return similarity(sentences)

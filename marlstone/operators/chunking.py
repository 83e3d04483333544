"""Documents to chunk rows.

Every strategy works inside the document's own row and then explodes, so no
chunker shuffles. A chunk is ``(doc_id, chunk_pos, chunk_strategy, content)``
next to the carried document columns; ``chunk_pos`` counts the produced pieces
from 0 before blank ones are dropped, so it never changes with later filters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions import text as tx
from marlstone.operators.embedding import Embedder, HashingEmbedder
from marlstone.session import stack

# Separators of the recursive strategy, strongest first.
SEPARATORS = ("\n\n", "\n", ". ", " ", "")
PARENT_SEPARATORS = ("\n\n", "\n", ". ", " ")
PIECES, TEXTS_AT_ONCE = pa.list_(pa.string()), 64
HEADER = r"(?md)^#{1,3}\s+.+$"


def _explode(docs: DataFrame, pieces: Column, strategy: str, text: str) -> DataFrame:
    kept = [c for c in docs.columns if c != text]
    return (
        docs.select(*kept, F.posexplode(pieces).alias("chunk_pos", "content"))
        .filter(tx.has_content("content"))
        .withColumn("chunk_strategy", F.lit(strategy))
    )


def _check_overlap(size: int, overlap: int) -> None:
    if size <= 0 or overlap < 0 or overlap >= size:
        raise ValueError(f"overlap must be in [0, size): size={size}, overlap={overlap}")


def chunk_fixed(docs: DataFrame, size: int = 500, overlap: int = 50, text: str = "text") -> DataFrame:
    """Windows of ``size`` characters, each starting ``size - overlap`` after the last."""
    _check_overlap(size, overlap)
    body = F.col(text)
    starts = F.when(F.length(body) > 0, F.sequence(F.lit(0), F.length(body) - 1, F.lit(size - overlap)))
    pieces = F.transform(starts, lambda s: F.substring(body, s + 1, size))
    return _explode(docs, pieces, "fixed", text)


def chunk_sentence(docs: DataFrame, size: int = 500, text: str = "text") -> DataFrame:
    """Sentences packed until the next one would pass ``size``; a long sentence stays whole."""
    acc0 = F.struct(
        F.array().cast("array<string>").alias("done"),
        F.array().cast("array<string>").alias("open"),
        F.lit(0).alias("used"),
    )

    def add(acc: Column, s: Column) -> Column:
        full = (acc["used"] + F.length(s) > size) & (F.size(acc["open"]) > 0)
        return F.struct(
            F.when(full, F.array_append(acc["done"], F.array_join(acc["open"], " ")))
            .otherwise(acc["done"]).alias("done"),
            F.when(full, F.array(s)).otherwise(F.array_append(acc["open"], s)).alias("open"),
            (F.when(full, F.lit(0)).otherwise(acc["used"]) + F.length(s) + 1).alias("used"),
        )

    pieces = F.aggregate(
        tx.sentences(text), acc0, add,
        lambda acc: F.when(F.size(acc["open"]) > 0,
                           F.array_append(acc["done"], F.array_join(acc["open"], " ")))
        .otherwise(acc["done"]),
    )
    return _explode(docs, pieces, "sentence", text)


def _pack(parts: list[str], size: int, overlap: int) -> Iterator[str]:
    """Join parts up to ``size``; a new piece starts with up to ``overlap`` trailing characters."""
    window: list[str] = []
    used = 0
    for part in parts:
        if window and used + len(part) > size:
            yield "".join(window)
            while window and (used > overlap or used + len(part) > size):
                used -= len(window.pop(0))
        window.append(part)
        used += len(part)
    if window:
        yield "".join(window)


def split_recursive(body: str, size: int, overlap: int, separators: tuple[str, ...]) -> list[str]:
    """Split at the strongest separator present, go deeper only for parts still too long."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in body), None)
    if at is None:
        return [body.strip()] if body.strip() else []
    sep, weaker = separators[at], separators[at + 1:]
    if sep == "":
        parts = list(body)
    else:
        first, *rest = body.split(sep)
        parts = [p for p in [first, *(sep + r for r in rest)] if p]
    out: list[str] = []
    short: list[str] = []
    for part in [*parts, None]:
        if part is not None and len(part) < size:
            short.append(part)
            continue
        out.extend(p.strip() for p in _pack(short, size, overlap))
        short = []
        if part is not None:
            deeper = split_recursive(part, size, overlap, weaker) if weaker else [part]
            out.extend(deeper)
    return [p for p in out if p]


def recursive_pieces(text: Column, size: int, overlap: int, separators: tuple[str, ...]) -> Column:
    """``array<string>`` of the recursive strategy (an Arrow-batched function)."""
    _check_overlap(size, overlap)

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def cut(bodies: pa.Array) -> pa.Array:
        parts = [pa.array([], PIECES)]
        for at in range(0, len(bodies), TEXTS_AT_ONCE):  # only so many texts are Python strings at one time
            texts = bodies.slice(at, TEXTS_AT_ONCE).to_pylist()
            parts.append(pa.array([[] if t is None else split_recursive(t, size, overlap, separators) for t in texts], PIECES))
        return pa.concat_arrays(parts)

    return cut(text)


def chunk_recursive(docs: DataFrame, size: int = 500, overlap: int = 50, text: str = "text",
                    separators: tuple[str, ...] = SEPARATORS) -> DataFrame:
    """Paragraphs, lines, sentences, words, characters: the strongest boundary that fits ``size``."""
    return _explode(docs, recursive_pieces(F.col(text), size, overlap, separators), "recursive", text)


def chunk_semantic(docs: DataFrame, threshold: float = 0.5, text: str = "text",
                   embedder: Embedder | None = None) -> DataFrame:
    """Start a new chunk where neighbouring sentences are less similar than ``threshold``."""
    embedder = embedder or HashingEmbedder()
    cut = docs.withColumn("_sents", tx.sentences(text)).withColumn(
        "_sims", embedder.neighbour_similarity(F.col("_sents")))
    acc0 = F.struct(
        F.array().cast("array<string>").alias("done"),
        F.array().cast("array<string>").alias("open"),
    )
    numbered = F.arrays_zip(F.col("_sents").alias("s"), F.col("_sims").alias("sim"))

    def add(acc: Column, item: Column) -> Column:
        new = (item["sim"] < threshold) & (F.size(acc["open"]) > 0)
        return F.struct(
            F.when(new, F.array_append(acc["done"], F.array_join(acc["open"], " ")))
            .otherwise(acc["done"]).alias("done"),
            F.when(new, F.array(item["s"])).otherwise(F.array_append(acc["open"], item["s"])).alias("open"),
        )

    packed = F.aggregate(numbered, acc0, add,
                         lambda acc: F.array_append(acc["done"], F.array_join(acc["open"], " ")))
    pieces = F.when(F.size("_sents") < 2, F.array(F.col(text))).otherwise(packed)
    return _explode(cut, pieces, "semantic", text).drop("_sents", "_sims")


def chunk_markdown(docs: DataFrame, size: int = 500, overlap: int = 50, text: str = "text",
                   keep_preamble: bool = False) -> DataFrame:
    """One chunk per ``#``, ``##`` or ``###`` section; a document without headers is cut recursively.

    Text before the first header is left out unless ``keep_preamble``.
    """
    body = F.col(text)
    gaps = F.split(body, HEADER, -1)
    heads = F.regexp_extract_all(body, F.lit(HEADER), F.lit(0))
    sections = F.transform(heads, lambda h, i: tx.strip(F.concat(h, F.get(gaps, i + 1))))
    if keep_preamble:
        sections = F.concat(F.array(tx.strip(F.get(gaps, F.lit(0)))), sections)
    headed = body.rlike(HEADER)
    with_headers = _explode(docs.filter(headed), sections, "markdown", text)
    plain = chunk_recursive(docs.filter(~headed), size, overlap, text)
    return stack(with_headers, plain)


def chunk_parent_child(docs: DataFrame, parent_size: int = 1000, parent_overlap: int = 100,
                       child_size: int = 200, child_overlap: int = 20, text: str = "text",
                       key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``(children, parents)``; a child names its parent by ``<doc_id>__p<n>``."""
    kept = [c for c in docs.columns if c != text]
    parents = docs.select(
        *kept,
        F.posexplode(recursive_pieces(F.col(text), parent_size, parent_overlap, PARENT_SEPARATORS))
        .alias("parent_idx", "content"),
    ).withColumn("parent_id", F.concat(F.col(key).cast("string"), F.lit("__p"), F.col("parent_idx")))
    children = parents.select(
        *kept, "parent_id",
        F.posexplode(recursive_pieces(F.col("content"), child_size, child_overlap, PARENT_SEPARATORS))
        .alias("child_idx", "content"),
    )
    return children, parents


def parents_of_hits(hits: DataFrame, children: DataFrame, parents: DataFrame,
                    chunk_id: str = "chunk_id") -> DataFrame:
    """Ranked child hits to their parents; a parent keeps the best rank of its children."""
    best = (
        hits.join(children.select(chunk_id, "parent_id"), chunk_id)
        .groupBy("query_id", "parent_id")
        .agg(F.min("rank").alias("rank"))
    )
    return best.join(parents.select("parent_id", F.col("content").alias("parent_content")), "parent_id")


STRATEGIES: dict[str, Callable[..., DataFrame]] = {
    "fixed": chunk_fixed,
    "recursive": chunk_recursive,
    "sentence": chunk_sentence,
    "semantic": chunk_semantic,
    "markdown": chunk_markdown,
}


def chunk_documents(docs: DataFrame, strategy: str = "recursive", **options) -> DataFrame:
    """Cut documents with the named strategy."""
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown chunking strategy '{strategy}'. Choose from: {list(STRATEGIES)}")
    return STRATEGIES[strategy](docs, **options)


def with_chunk_id(chunks: DataFrame, key: str = "doc_id") -> DataFrame:
    """A stable id from the document key and the position inside it."""
    return chunks.withColumn(
        "chunk_id", F.concat(F.lit("chunk_"), F.col(key).cast("string"), F.lit("_"), F.col("chunk_pos")))

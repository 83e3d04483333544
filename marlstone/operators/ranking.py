"""Ranks inside queries and exact padding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.session import stack

# Groups whose first rows a task remembers.
GROUPS = 20_000


def top_k(scored: DataFrame, k: int | None, *order: Column, per: tuple[str, ...] = ("query_id",),
          rank: str = "rank") -> DataFrame:
    """Rank rows from 1 inside ``per`` and keep the first ``k``.

    ``row_number() <= k`` lets Spark cut to ``k`` rows per query in every task
    before the shuffle, so a query with very many candidates is no hot spot.
    """
    ranked = scored.withColumn(rank, F.row_number().over(Window.partitionBy(*per).orderBy(*order)))
    return ranked if k is None else ranked.filter(F.col(rank) <= k)


def without_late(rows: DataFrame, k: int, group: str, name: str, number: str) -> DataFrame:
    """``rows`` without rows that are surely behind the first ``k`` of their ``group`` by ``name`` and ``number``.

    For very many rows of few groups, which need not be sorted then. A task remembers the first ``k`` places of each group
    that it has met and passes on the rows that are not behind the last of them, those of the same place too.
    ``group`` and ``number`` are of long type and not null, ``name`` is a string.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list[tuple[tuple[bool, str], int]]] = {}
        for batch in batches:
            if len(known) > GROUPS:
                known.clear()
            coded, names = batch.column(group).dictionary_encode(), batch.column(name).dictionary_encode()
            groups, keys = coded.dictionary.to_pylist(), [(True, n) for n in names.dictionary.to_pylist()] + [(False, "")]
            code, word = coded.indices.to_numpy(), names.indices.fill_null(len(keys) - 1).to_numpy()
            at = batch.column(number).to_numpy()
            kept = np.flatnonzero(at <= _bounds(known, groups, keys, k)[code, word])
            rank = np.argsort(sorted(range(len(keys)), key=keys.__getitem__))
            kept = kept[np.lexsort((at[kept], rank[word[kept]], code[kept]))]
            starts = np.flatnonzero(np.diff(code[kept], prepend=-1))
            for low, high in zip(starts, np.append(starts[1:], len(kept))):
                few, g = kept[low:min(low + k, high)], groups[code[kept[low]]]
                known[g] = sorted(known.get(g, []) + [(keys[w], int(n)) for w, n in zip(word[few], at[few])])[:k]
            kept = kept[at[kept] <= _bounds(known, groups, keys, k)[code[kept], word[kept]]]
            yield batch.take(pa.array(np.sort(kept)))

    return rows.mapInArrow(run, rows.schema)


def _bounds(known: dict, groups: list[int], keys: list[tuple[bool, str]], k: int) -> np.ndarray:
    """The largest number that a row of each group and name may have."""
    least, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    out = np.full((len(groups), len(keys)), most)
    for i, g in enumerate(groups):
        if len(known.get(g, ())) == k:
            last, number = known[g][-1]
            out[i] = [most if n < last else number if n == last else least for n in keys]
    return out


def pad_with_first(best: DataFrame, queries: DataFrame, corpus: DataFrame, k: int, id_col: str,
                   value: str) -> DataFrame:
    """Add zero-valued rows to the best ``k`` hits so that every query can fill ``k`` places.

    Only a query with fewer than ``k`` hits has a zero row among its first ``k``,
    and such a row is then one of the ``k`` smallest ids of the corpus. So those
    ``k`` ids are all that must be offered, not the whole corpus.
    """
    first = corpus.select(id_col).orderBy(id_col).limit(k)
    offered = queries.select("query_id").distinct().select(
        "query_id", F.explode(first.agg(F.collect_list(id_col)).scalar()).alias(id_col),
        F.lit(0).cast(best.schema[value].dataType).alias(value))
    return stack(best.select("query_id", id_col, value), offered).groupBy("query_id", id_col).agg(
        F.max(value).alias(value))

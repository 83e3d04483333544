"""Top-k per query in one pass over a corpus, without shuffling the scores.

Each task scores its Arrow batches against all queries of a bounded batch and
keeps only the best ``k`` rows per query while it reads. What leaves a task is
``k`` rows per query; a window over those gives the final ranks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from marlstone.operators.ranking import top_k

# Scores, and entries of list columns, held at one time inside a task.
SCORE_CELLS = 1_000_000
LIST_ENTRIES = 100_000
NO_SCORE = -np.inf


def as_ids(values) -> np.ndarray:
    out = np.asarray(values)
    return out.astype(str) if out.dtype == object else out


def parts_of(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows and, beyond a single row, ``LIST_ENTRIES`` entries of the last column's lists.

    What a scorer holds is then bounded whatever the length of the texts in a batch.
    """
    lists, at = batch.column(batch.num_columns - 1), 0
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    if pa.types.is_list(lists.type):
        sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    ends = np.cumsum(sizes)
    while at < batch.num_rows:
        fits = int(np.searchsorted(ends, ends[at] - sizes[at] + LIST_ENTRIES, "right"))
        last = max(at + 1, min(at + rows, fits))
        yield batch.slice(at, last - at)
        at = last


class TopRows:
    """The best ``k`` corpus rows per query seen so far; ties go to the smaller id."""

    def __init__(self, query_ids: np.ndarray, k: int, skip_self: bool = False):
        self.query_ids, self.k, self.skip_self = query_ids, k, skip_self
        self.worst = np.full(len(query_ids), np.finfo(np.float64).min)
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.array([]), np.array([]))] * len(query_ids)

    def step(self) -> int:
        """How many corpus rows to score at a time."""
        return max(1, SCORE_CELLS // max(1, len(self.query_ids)))

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores[q, row]``; ``NO_SCORE`` marks a row that is no hit of the query."""
        if scores.size == 0:
            return
        scores = np.where(np.isnan(scores), NO_SCORE, scores)  # a vector with such a component is no hit
        for q in np.nonzero(scores.max(axis=1) >= self.worst)[0]:
            row = scores[q]
            keep = np.nonzero(row >= self.worst[q])[0]
            if self.skip_self:
                keep = keep[ids[keep] != self.query_ids[q]]
            if len(keep) > self.k:
                line = row[keep]
                keep = keep[line >= np.partition(line, -self.k)[-self.k]]
            best_ids, best = self.found[q]
            all_ids = np.concatenate([best_ids, ids[keep]]) if len(best) else ids[keep]
            all_scores = np.concatenate([best, row[keep]])
            order = np.lexsort((all_ids, -all_scores))[: self.k]
            self.found[q] = (all_ids[order], all_scores[order])
            if len(order) == self.k:
                self.worst[q] = all_scores[order[-1]]

    def table(self, arrow: pa.Schema) -> pa.Table:
        hits = [(q, i, s) for q, (i, s) in zip(self.query_ids, self.found) if len(i)]
        if not hits:
            return arrow.empty_table()
        columns = (
            np.repeat(np.array([q for q, _, _ in hits]), [len(i) for _, i, _ in hits]),
            np.concatenate([i for _, i, _ in hits]),
            np.concatenate([s for _, _, s in hits]),
        )
        return pa.table([pa.array(c).cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)


def hit_schema(query_id: T.DataType, id_col: str, id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("query_id", query_id), T.StructField(id_col, id_type),
                         T.StructField("score", T.DoubleType())])


def scan_top_k(rows: DataFrame, schema: T.StructType, query_ids: np.ndarray, k: int,
               scorer: Callable[[pa.RecordBatch], np.ndarray], skip_self: bool = False) -> DataFrame:
    """``scorer(batch)`` gives ``scores[q, row]``; the first column of ``rows`` is the id."""
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = TopRows(query_ids, k, skip_self)
        for batch in batches:
            for part in parts_of(batch, best.step()):
                best.offer(as_ids(part.column(0).to_numpy(zero_copy_only=False)), scorer(part))
        yield from best.table(arrow).to_batches()

    id_col = schema.names[1]
    return top_k(rows.mapInArrow(scan, schema), k, F.col("score").desc(), F.col(id_col).asc())

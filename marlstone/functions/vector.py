"""Vector expressions on ``array<float>`` columns; all sums run in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")))


def l2_norm(a: Column | str) -> Column:
    return F.sqrt(_sum(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 when a vector has no length."""
    size = l2_norm(a) * l2_norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / size)


def unit(a: Column | str) -> Column:
    """The vector scaled to length 1; a zero vector is kept."""
    size = l2_norm(a)
    return F.when(size == 0, _c(a)).otherwise(
        F.transform(_c(a), lambda x: (x.cast("double") / size).cast("float")))


def mean_value(a: Column | str) -> Column:
    return _sum(F.transform(_c(a), lambda x: x.cast("double"))) / F.size(_c(a))

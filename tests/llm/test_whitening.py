"""Whitening against a plain dense computation."""

import math

import numpy as np
import pytest

from marlstone.llm import queries, whitening

FOLDER = "/root/testdata/sf0.001"


def brute(rows, components=4):
    """vec_id, component, n, deviation, whitened (sign free), explained of vectors given as lists."""
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    longest = max((len(v) for _, v in rows), default=0)
    xs = [(i, tuple([math.floor(256 * c) for c in v] + [0] * (longest - len(v)))) for i, v in rows]
    fit = sorted({x for _, x in xs})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    centred = np.array([[x - s / n for x, s in zip(row, sums)] for row in fit])
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    out = []
    for i, x in xs:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for c in range(min(components, longest)):
            e = values[-1 - c]
            w = None
            if e > np.trace(cov) * longest * 2 ** -52:
                w = abs(float(np.dot([a - s / n for a, s in zip(x, sums)], axes[:, -1 - c]) / math.sqrt(e)))
            out.append((i, c + 1, n, deviation if deviation < 2 ** 63 else None, w, e / np.trace(cov) if np.trace(cov) > 0 else None))
    return out


def compare(got, want):
    key = lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    got = sorted([(r[0], r[1], r[2], r[3], None if r[4] is None else round(abs(r[4]), 7), r[5]) for r in got], key=key)
    want = sorted([(r[0], r[1], r[2], r[3], None if r[4] is None else round(r[4], 7), r[5]) for r in want], key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:4] == b[:4]
        assert (a[4] is None) == (b[4] is None) and (a[5] is None) == (b[5] is None)
        assert a[4] is None or abs(a[4] - b[4]) < 1e-6
        assert a[5] is None or abs(a[5] - b[5]) < 1e-9


def test_query_against_dense(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    got = queries.op11_whitening(spark, FOLDER).collect()
    compare(got, brute(rows))
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9
    by = {c: np.array([r.whitened for r in sorted(got, key=lambda r: r.vec_id) if r.component == c]) for c in (1, 2, 3, 4)}
    for a in by:  # one sign for all rows: the components are uncorrelated and of unit variance as they stand
        for b in by:
            assert abs(np.mean(by[a] * by[b]) - (a == b)) < 1e-6


@pytest.mark.parametrize("block", [3, 7, whitening.BLOCK])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK", block)
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, 0.5, -0.3]), (1, [0.1, 0.5, -0.3]), (2, None), (3, [0.1, None, 0.2]), (4, [nan, 0.0, 0.0]), (5, [inf, 0.0, 0.0]),
            (None, [0.9, -0.2, 0.4]), (6, [0.1, 0.5]), (7, []), (8, [-0.7, 0.1, 0.0]), (9, [0.1001, 0.5001, -0.2999])]
    df = spark.createDataFrame([(*r, 1, 2.0, "k") for r in rows],
                               "vec_id long, embedding array<double>, n int, whitened double, component string")
    got = whitening.whiten(df).collect()
    compare(got, brute(rows))
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.where("vec_id = 7")).collect() == []
    one = whitening.whiten(df.where("vec_id = 1"), 2).collect()
    assert sorted(tuple(r) for r in one) == [(1, c, 1, 0, None, None, None) for c in (1, 1, 2, 2)]


def test_hot_vector_and_flat_dimension(spark):
    rows = [(i, [0.25, 0.5, 1.0]) for i in range(500)] + [(1000 + i, [i / 64, 0.5, (i * i % 17) / 16]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    got = whitening.whiten(df)
    compare(got.collect(), brute(rows))


def test_large_entries(spark):
    rows = [(1, [1e6, 0.0]), (2, [-3e9, 1.0]), (3, [5.0, 2.0]), (4, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in whitening.whiten(df, 1).collect()}
    x = [(min(math.floor(256 * a), 1 << 53), math.floor(256 * b)) for _, (a, b) in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i + 1: sum((4 * a - s) ** 2 for a, s in zip(row, sums)) for i, row in enumerate(x)}
    assert got == {k: v if v < 1 << 63 else None for k, v in want.items()}


def test_blocks_are_numbered_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 8)
    rows = spark.createDataFrame([(i, [i, i]) for i in range(50)], "id long, x array<long>").repartition(5)
    parts, end = whitening.numbered(whitening.blocks(rows, 2))
    found = parts.select("b", "rows", "ids", "x").collect()
    assert sorted(r.b for r in found) == list(range(end)) and max(r.rows for r in found) <= 4
    assert sorted(i for r in found for i in r.ids) == list(range(50))
    assert all(r.x == [v for i in r.ids for v in (i, i)] for r in found)

"""Exact percentiles against sorted lists."""

import math
import random

import pytest

from marlstone.operators import evaluation
from marlstone.operators.quantiles import exact_percentiles


def plain(values, p):
    values = sorted(values, key=lambda v: (math.isnan(v), v))
    at = p * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low if low == high else low * (1 - (at - math.floor(at))) + high * (at - math.floor(at))


@pytest.mark.parametrize("rows,splitters", [(10_000, 128), (20, 4), (3, 2)])
def test_groups_of_any_shape(spark, rows, splitters):
    rng = random.Random(7)
    groups = {
        "hot": [rng.gauss(0, 1) for _ in range(1500)],
        "tied": [5.0] * 300 + [float(i) for i in range(40)],
        "steep": [2.0 ** k for k in range(-200, 200)],
        "two": [1.0, 2.0], "one": [3.0], None: [float(i % 7) for i in range(90)],
        "odd": [float("inf"), float("-inf"), float("nan")] * 20 + [0.0, -0.0] * 10,
    }
    data = [(g, v) for g, vs in groups.items() for v in vs] + [("hot", None), ("none", None)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, x double")
    got = {(r.g, r.fraction): r.percentile for r in exact_percentiles(df, "x", [0, 0.5, 0.99, 1], ["g"], rows, splitters).collect()}
    want = {(g, p): plain(vs, p) for g, vs in groups.items() for p in (0, 0.5, 0.99, 1)}
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12, nan_ok=True), k


def test_whole_table_and_no_rows(spark):
    df = spark.range(1001).selectExpr("cast(id as int) as x")
    assert [tuple(r) for r in exact_percentiles(df, "x", [0.25], sorted_rows=10, splitters=3).collect()] == [(0.25, 250.0)]
    assert exact_percentiles(df.limit(0), "x", [0.5]).collect() == []
    with pytest.raises(ValueError):
        exact_percentiles(df, "x", [2])


def test_no_task_holds_a_method(spark):
    """90 % of the rows are of one method; no percentile buffer is left, and only cells of bounded size are collected."""
    df = spark.range(60_000).selectExpr("if(id % 10 = 0, 'b', 'a') as m", "cast(id * 7919 % 60000 as double) as s")
    out = evaluation.latency_summary(df, "m", "s", "b")
    got = {r.method: r.p99 for r in out.collect()}
    for m, keep in (("a", lambda i: i % 10), ("b", lambda i: not i % 10)):
        assert got[m] == pytest.approx(plain([float(i * 7919 % 60000) for i in range(60_000) if keep(i)], 0.99))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in plan

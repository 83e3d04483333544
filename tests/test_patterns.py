"""Texts in texts, by the automaton and by the join, against plain ``in``."""

import random
import time

import numpy as np
import pytest

from marlstone.operators import entities, patterns
from marlstone.operators.patterns import Finder, contained


def made(rng, n, most, letters="ab é😀"):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("bounds", [{}, {"patterns": 0}, {"characters": 3}])
def test_contained(spark, bounds):
    rng = random.Random(3)
    texts = made(rng, 60, 60) + [None, "", "aaaa", "aaaa"]
    needles = made(rng, 80, 9) + [None, "", "zz", "aaaa" * 20, "a", "a"]
    hay = spark.createDataFrame([(i, f"k{i % 7}", t, 1) for i, t in enumerate(texts)], "id long, kind string, hay string, _hay2 int")
    few = spark.createDataFrame([(n,) for n in needles], "needle string")
    got = [tuple(r) for r in contained(hay, ["id", "kind"], "hay", few, "needle", **bounds).collect()]
    want = {(i, f"k{i % 7}", n) for i, t in enumerate(texts) if t is not None for n in needles if n and n in t}
    assert len(got) == len(set(got)) and set(got) == want
    assert contained(hay.limit(0), ["id"], "hay", few, "needle", **bounds).collect() == []
    assert contained(hay, ["id"], "hay", few.limit(0), "needle", **bounds).collect() == []


def test_long_texts_are_linear():
    finder = Finder(["a" * n for n in range(1, 40)] + ["ab", "needle"])
    start = time.perf_counter()
    assert len(finder.inside("a" * 1_000_000 + "needle")) == 40
    assert time.perf_counter() - start < 20


def test_rolling_hash_of_windows():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 3, 200).astype(np.uint32)
    with np.errstate(over="ignore"):
        for size in (1, 2, 4, 16):
            seen = {}
            for at, h in enumerate(patterns.rolling(codes, size).tolist()):
                assert seen.setdefault(codes[at:at + size].tobytes(), h) == h
            assert len(set(seen.values())) == len(seen)


def test_no_text_is_shuffled(spark):
    hay = spark.range(10).selectExpr("id", "repeat('x y ', 1000) as hay")
    needle = spark.createDataFrame([("y x",)], "needle string")
    for bounds in ({}, {"patterns": 0}):
        plan = contained(hay, ["id"], "hay", needle, "needle", **bounds)._jdf.queryExecution().executedPlan().toString()
        assert "_hay" not in plan[:plan.index("MapInArrow")]


def test_phrases_of_several_labels():
    found = entities.find_entities("fit and proper, ORSA, annual ORSA and xORSA", entities.Phrases(
        [("ORSA", "A"), ("annual ORSA", "B"), ("ORSA", "B"), ("proper", "C")]), [])
    assert found == [(8, 14, "C"), (16, 20, "A"), (22, 33, "B")]

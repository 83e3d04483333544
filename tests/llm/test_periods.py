"""Runs of words against a search over all periods, and the transform against plain sums."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from marlstone.llm import periods, queries
from tests.llm.brute import plain_words

FOLDER = "/root/testdata/sf0.001"


def brute_runs(w, least=6, power=4):
    """Every maximal stretch of each period, the smallest period of equal stretches."""
    best = {}
    for q in range(1, len(w) // power + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i + q - s
            if length >= max(least, power * q):
                best.setdefault((s, length), q)
    return sorted((s, n, q) for (s, n), q in best.items())


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def brute_row(doc_id, w):
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


@pytest.mark.parametrize("prime,generator", periods.PRIMES)
def test_transform(prime, generator):
    rng = np.random.default_rng(1)
    for size in (1, 2, 4, 64):
        x = rng.integers(0, prime, (3, size)).astype(np.uint64)
        y = rng.integers(0, prime, (3, size)).astype(np.uint64)
        got = periods.back(periods.transform(x, prime, generator) * periods.transform(y, prime, generator) % np.uint64(prime),
                           prime, generator)
        for a, b, c in zip(x.tolist(), y.tolist(), got.tolist()):
            assert c == [sum(a[i] * b[(k - i) % size] for i in range(size)) % prime for k in range(size)]


def test_generators():
    for prime, g in periods.PRIMES:
        rest, factors, f = prime - 1, set(), 2
        while rest > 1:
            while rest % f == 0:
                factors.add(f)
                rest //= f
            f += 1
        assert all(pow(g, (prime - 1) // f, prime) != 1 for f in factors)


@pytest.mark.parametrize("largest", [2, 40000, 3 * 10 ** 8])
def test_recurrences(largest):
    """Also with codes that need two and three primes; differences may be multiples of a prime."""
    rng = np.random.default_rng(largest)
    for size in (1, 2, 8):
        codes = rng.choice(np.array([1, largest, max(2, largest // 2)], dtype=np.uint64), 40)
        starts = np.arange(0, 40 - 3 * size, size)
        got = periods.recurrences(codes, starts, size)
        for row, s in zip(got, starts):
            assert row.tolist() == [codes[s:s + size].tolist() == codes[s + d:s + d + size].tolist() for d in range(size, 2 * size)]


def made(rng):
    kind, n = rng.random(), rng.choice([0, 1, 5, 6, 7, 30, 90, 200])
    if kind < 0.2:
        return [rng.choice("ab") for _ in range(n)]
    if kind < 0.3:
        return ["a"] * n
    w = []
    while len(w) < n:
        q = rng.randint(1, 12)
        unit = [rng.choice("abcdef") for _ in range(q)]
        w += unit * rng.randint(1, 7) + unit[:rng.randint(0, q)] + [rng.choice("abcdefgh")] * rng.randint(0, 2)
    return w


def test_runs_of_many():
    rng = random.Random(5)
    docs = [made(rng) for _ in range(400)]
    texts = [" ".join(w) for w in docs]
    for part in (texts, *[[t] for t in texts[:60]]):
        _, codes, lengths = periods._coded(part)
        for w, got in zip(part, periods.runs_of(codes, lengths)):
            assert [tuple(r) for r in got.tolist()] == sorted(brute_runs(w.split()), key=lambda r: (r[0], r[2]))


def test_fibonacci_and_nested():
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    nested = (("x " * 7 + "y ") * 6 + "z ") * 5
    for w in (list(b), nested.split(), list("aabaab" * 40), list("ab" * 3), list("a" * 6), list("a" * 5)):
        _, codes, lengths = periods._coded([" ".join(w)])
        assert [tuple(r) for r in periods.runs_of(codes, lengths)[0].tolist()] == sorted(brute_runs(w), key=lambda r: (r[0], r[2]))


def test_long_texts_are_quick():
    import time
    unit = [f"w{i}" for i in range(50000)]
    for w, runs in ((["a"] * 300000, [(0, 300000, 1)]), (unit * 5 + unit[:7], [(0, 250007, 50000)]),
                    (unit + ["b", "c"] * 100000, [(50000, 200000, 2)])):
        start = time.perf_counter()
        _, codes, lengths = periods._coded([" ".join(w)])
        assert [tuple(r) for r in periods.runs_of(codes, lengths)[0].tolist()] == runs
        assert time.perf_counter() - start < 20


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in queries.op12_periods(spark, FOLDER).collect()}
    assert got == {brute_row(r.doc_id, planted(r.doc_id, plain_words(r.text))) for r in rows}
    assert sum(r[1] > 0 for r in got) > 5


def test_odd_rows(spark):
    long = "alpha beta gamma " * 800
    texts = [None, "", " \n\t ", "one", "a\x0bb\x0ca\rb a b a b a b a b", long, "é " * 9, "a b " * 30]
    rows = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (None, "x " * 10)]
    df = spark.createDataFrame([(*r, 1, "k", 2.0) for r in rows], "doc_id long, text string, runs int, n_words string, h double")
    got = sorted((tuple(r) for r in periods.digest(periods.find_runs(periods.with_planted_periods(df))).collect()), key=repr)
    brute = [brute_row(i, planted(i, plain_words(t)) if i is not None else plain_words(t)) for i, t in rows]
    assert got == sorted(brute, key=repr)
    assert periods.find_runs(df.limit(0)).count() == 0
    spans = periods.find_runs(spark.createDataFrame([("k", "go go go go go go on")], "doc_id string, text string")).first()
    assert (spans.n_words, [tuple(r) for r in spans.runs], spans.collapsed) == (7, [(0, 6, 1)], "go on")

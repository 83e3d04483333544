"""SimHash: fingerprints, links and groups against brute force."""

from itertools import combinations

import numpy as np
import pytest
import xxhash

from marlstone.llm import golay, simhash
from marlstone.llm.common import table
from tests.llm.brute import components, plain_words

FOLDER = "/root/testdata/sf0.001"


def brute_print(text, size=3):
    tokens = [w.decode() for w in plain_words(text, lower=True)]
    pieces = [" ".join(tokens[i:i + size]) for i in range(len(tokens) - size + 1)] or ([" ".join(tokens)] if tokens else [])
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, size=3):
    prints = [brute_print(t, size) for _, t in rows]
    first = {}
    for i, p in enumerate(prints):
        first.setdefault(p, i)
    edges = [(first[p], i) for i, p in enumerate(prints)]
    edges += [(first[a], first[b]) for a, b in combinations(first, 2) if (a ^ b).bit_count() <= 2]
    roots = components(range(len(rows)), edges)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[roots[i]] = min(doc, least.get(roots[i], doc))
    return sorted(((d, f"{p:016x}", least.get(roots[i])) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_two_errors_share_a_key():
    words = np.arange(1 << 11)  # one word of each coset; the code is linear
    own = golay.keys(words)
    for bits in [c for n in (0, 1, 2) for c in combinations(range(23), n)]:
        other = golay.keys(words ^ sum(1 << b for b in bits))
        assert ((own[:, :, None] == other[:, None, :]) & (own[:, :, None] >= 0)).any((1, 2)).all()


def test_documents(spark):
    docs = table(spark, FOLDER, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(simhash.simhash_components(docs)) == brute(rows)


@pytest.mark.parametrize("paired", [64, 2])
def test_links_on_both_ways(spark, paired):
    rng = np.random.default_rng(3)
    base = int(rng.integers(1 << 62))
    near = {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (150, 2))}
    prints = sorted(near | {int(x) for x in rng.integers(0, 1 << 62, 100)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = simhash.links(spark.createDataFrame([(p,) for p in signed], "fingerprint long"), paired)
    edges = [(r.u, r.v) for r in df.collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in edges)
    truth = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    assert components(signed, edges) == components(signed, truth)


def test_edges_of_input(spark):
    long = "alpha beta gamma delta " * 9000
    rows = [(1, None), (2, ""), (3, " \n"), (None, long), (5, long), (6, "one"), (6, "one"), (7, "ONE"), (None, "x y z w")]
    df = spark.createDataFrame([(d, t, "a", 1) for d, t in rows], "doc_id long, text string, fingerprint string, node int")
    assert got(simhash.simhash_components(df)) == brute(rows)
    assert simhash.simhash_components(df.limit(0)).count() == 0


def stays(rows):
    """Indices of the rows that stay: the smallest id of each component, of rows alike any one."""
    prints = [brute_print(t) for _, t in rows]
    edges = [(i, j) for i, j in combinations(range(len(rows)), 2) if (prints[i] ^ prints[j]).bit_count() <= 2]
    roots = components(range(len(rows)), edges)
    best = {}
    for i, (doc, _) in enumerate(rows):
        best.setdefault(roots[i], []).append((doc is None, doc or 0))
    return sorted(min(v) for v in best.values())


def test_one_of_each(spark):
    """Exact copies, copies with one word changed in a long text, rows alike, no ids, no texts, clashing names."""
    rng = np.random.default_rng(5)
    def prose(n):
        return [f"w{int(x)}" for x in rng.integers(0, 900, n)]
    rows = []
    for g in range(6):
        base = prose(3000)
        rows += [(len(rows) + c, " ".join(base[:-1] + [f"end{c}"] if c % 2 else base)) for c in range(6)]
    clean = [len(rows) + i for i in range(60)]
    rows += [(i, " ".join(prose(200))) for i in clean]
    rows += [(500, None), (501, ""), (None, "same text here"), (502, "same text here"), (503, "twice the same"), (503, "twice the same"),
             (None, "never an id"), (None, "never an id")]
    df = spark.createDataFrame([(d, t, 1, "r", True, 0.5) for d, t in rows],
                               "doc_id long, text string, _h int, row string, stays boolean, fingerprint double").repartition(5)
    out = simhash.one_of_each(df)
    assert out.columns == df.columns
    got = [tuple(r) for r in out.collect()]
    assert sorted((r[0] is None, r[0] or 0) for r in got) == stays(rows)
    assert all(r[2:] == (1, "r", True, 0.5) for r in got)
    left = {r[0] for r in got}
    assert set(clean) <= left and 500 in left and 501 not in left and 502 in left and {0, 6, 12} <= left and 2 not in left
    assert simhash.one_of_each(df.limit(0)).count() == 0


def test_one_of_each_of_documents(spark):
    docs = table(spark, FOLDER, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    left = [tuple(r) for r in simhash.one_of_each(docs).collect()]
    assert sorted((r[0] is None, r[0]) for r in left) == stays(rows)
    assert set(left) <= {tuple(r) for r in docs.collect()}

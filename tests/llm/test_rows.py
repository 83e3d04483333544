"""Operators that judge or render rows, against plain versions on small tables."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import contamination, language, mixing, perspectives, quality, queries, revisits, rules, urls
from marlstone.llm.common import table
from tests.llm.brute import plain_words

FOLDER = "/root/testdata/sf0.001"
LONG = "alpha beta gamma. " * 12000
TEXTS = [None, "", " \n\t ", "one", "a b a b a b a b", "x\x0by\x0cz", "é ü #$ | <b>", LONG, "l1\nl1\n\n \nl1 \nl2", "dup words here " * 30]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 3 else None) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (None, "no id at all", "en", "s1")]
    return spark.createDataFrame([(*r, 1, 0.5, "k") for r in rows],
                                 "doc_id long, text string, lang string, source string, size int, score double, kept string")


# op3


def same_as_sql(spark, df, con, least=rules.LEAST_ROWS):
    got = rules.judge(df, least)
    cursor = con.execute(rules.judge_sql(least))
    assert got.columns == [c[0] for c in cursor.description]
    assert rows_of(got) == sorted(cursor.fetchall(), key=repr)


@pytest.mark.parametrize("least", [2, 50])
def test_rules(spark, odd, least):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    same_as_sql(spark, table(spark, FOLDER, "documents"), con, least)
    con = duckdb.connect()
    frame = odd.toPandas()  # noqa: F841
    con.execute("CREATE TABLE documents AS SELECT * FROM frame")
    same_as_sql(spark, odd, con, least)
    assert rules.judge(odd.limit(0)).count() == 0


def test_sketch_buckets(spark):
    values = [*range(0, 300), 1000, 4095, 4096, 10 ** 6, 10 ** 9]
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", rules.bucket(F.col("v")).alias("b"))
    for r in df.withColumn("top", rules.bucket_top(F.col("b"))).collect():
        assert r.v <= r.top <= r.v + max(0, r.v // 32)


# op7


def brute_rule(url):
    if not url or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for verdict, rule in urls.RULES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return host, path, *(best or (None, None))


def test_urls(spark):
    pages = [(r.page_id, r.url) for r in table(spark, "/root/testdata/sf0.01", "pages").collect()]
    pages += [(9000 + i, u) for i, u in enumerate(
        [None, "", "no scheme", "HTTP://WWW.Example.COM/en/x?y", "a://b://c/d", "x://notcom/", "x://com", "x://Com/q#f", "http://é.net/es/",
         "x://a\nb.net/fr/", "https://q.org/" + "long" * 30000, "://", "http://example.com/EN/"])]
    pages += pages[-2:] + [(None, "http://z.org/")]
    df = spark.createDataFrame([(p, u, 1, "r") for p, u in pages], "page_id long, url string, score int, rule string")
    got = rows_of(urls.judge(df))
    assert len(got) == len(pages)
    known = {}
    for page_id, url in pages:
        known[page_id] = brute_rule(url)
    codes = {c: i + 1 for i, c in enumerate(urls.LETTERS)}
    for page_id, host, path, rule, verdict, score, threshold in got:
        assert (host, path, rule) == known[page_id][:3]
        assert verdict == (known[page_id][3] or ("allow" if score >= threshold else "block"))
    # the models, from their definition
    def triples(url):
        body = (url or "").lower() if (url or "").isascii() else "".join(c.lower() if c.isascii() else c for c in url)
        body = body.split("://", 1)[-1] if "://" in body else body
        own = [urls.START] * 2 + [codes.get("0" if c in "123456789" else c, 0) for c in body]
        return [tuple(own[i:i + 3]) for i in range(len(own) - 2)]
    held = {r.url: r.h for r in df.select("url", (F.pmod(F.xxhash64(F.lit("held"), "url"), F.lit(urls.HELD_PART)) == 0).alias("h")).collect()}
    counts = {"allow": Counter(), "block": Counter()}
    for page_id, url in pages:
        verdict = brute_rule(url)[3]
        if verdict and not held[url]:
            counts[verdict].update(triples(url))
    import math

    def chance(count, t):
        p = 1 / urls.CLASSES
        for size in (1, 2, 3):
            follow = Counter()
            for key, n in count.items():
                if key[3 - size:2] == t[3 - size:2]:
                    follow[key[2]] += n
            total = sum(follow.values())
            p = (follow[t[2]] + len(follow) * p) / (total + len(follow)) if total else p
        return p
    scores = {r[0]: r[5] for r in got}
    for page_id, url in [*pages[:6], *pages[-10:-4]]:
        parts = triples(url)
        if parts and len(parts) < 200:
            want = sum(round(math.log(chance(counts["allow"], t) / chance(counts["block"], t)) * 1e6) for t in parts) // len(parts)
            assert abs(scores[page_id] - want) <= 1
    assert urls.judge(df.limit(0)).count() == 0
    assert urls.calibrate([(-3, 0, 5), (4, 5, 0)]) > -3 * urls.STEP


# op8


def brute_targets(sizes, weights=mixing.WEIGHTS):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        share = sum(w[s] for s in names if s not in stopped)
        target = {s: 3.0 * sizes[s] if s in stopped else left * w[s] / share for s in names}
        over = {s for s in names if s not in stopped and target[s] >= 3 * sizes[s]}
        if not over:
            return target
        stopped |= over
        if len(stopped) == len(names):
            return {s: 3.0 * sizes[s] for s in names}


@pytest.mark.parametrize("bucket", [64, 3])
def test_mixture(spark, odd, bucket):
    docs = table(spark, FOLDER, "documents").unionByName(
        spark.createDataFrame([(100000 + i, f"w{i} " * (1 + i % 90), "en", "tiny", 1) for i in range(40)]
                              + [(200000, None, "en", None, 0), (200001, "last one", "en", None, 0), (5, "", None, "zero", 0)],
                              "doc_id long, text string, lang string, source string, n_chars long"))
    for frame in (docs, odd):
        rows = frame.collect()
        size = lambda t: len(plain_words(t))
        sizes = defaultdict(int)
        for r in rows:
            sizes[r.source] += size(r.text)
        want, got = brute_targets(sizes), mixing.mixture(frame, bucket=bucket).collect()
        assert Counter((r.doc_id, size(r.text)) for r in rows) == Counter((g.doc_id, g["size"]) for g in got)
        of = {(r.doc_id, size(r.text)): r.source for r in rows}
        taken, biggest = defaultdict(int), defaultdict(int)
        for g in got:
            source = of[g.doc_id, g["size"]]
            assert g.source_size == sizes[source] and g.target == pytest.approx(want[source])
            assert g.taken == g["size"] * g.copies and 0 <= g.copies <= 3
            taken[source] += g.taken
            biggest[source] = max(biggest[source], g["size"])
        for source in sizes:
            assert abs(taken[source] - want[source]) <= biggest[source] + 1e-6
        assert rows_of(mixing.mixture(frame, bucket=bucket)) == sorted(map(tuple, got), key=repr)
        assert mixing.mixed(frame, bucket=bucket).columns == frame.columns
        assert mixing.mixed(frame, bucket=bucket).count() == sum(g.copies for g in got)
    assert mixing.mixture(odd.limit(0)).count() == 0


def test_mixture_of_repeated_rows_and_clashing_names(spark):
    """Rows alike are documents of their own, in numbers and in the rows that are taken; ids may be strings."""
    text = lambda i: f"w{i} " * 100
    rows = [("same", text(0), "a", i, "x") for i in range(50)] + [(f"d{i}", text(i), "a", i, "y") for i in range(10)]
    rows += [(f"e{i}", text(i), "b", i, None) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id string, text string, source string, _h int, copies string").withColumns(
        {"_g": F.lit(1), "_copy": F.lit("c"), "m": F.lit(2.5), "nr": F.lit(None).cast("int"), "row": F.lit("r")})
    got = mixing.mixture(df).collect()
    target = {r.doc_id[0]: r.target for r in got}
    for kinds, goal in (("sd", target["d"]), ("e", target["e"])):
        assert abs(sum(r.taken for r in got if r.doc_id[0] in kinds) - goal) <= 100
    out = mixing.mixed(df)
    assert out.dtypes == df.dtypes
    taken = Counter(tuple(r) for r in out.collect())
    assert set(taken) <= {tuple(r) for r in df.collect()}
    assert sorted(taken[tuple(r)] for r in df.collect() if r.doc_id == "same") == sorted(r.copies for r in got if r.doc_id == "same")
    assert Counter({r[0]: n for r, n in taken.items() if r[0] != "same"}) == Counter({r.doc_id: r.copies for r in got if r.doc_id != "same" and r.copies})
    assert mixing.mixed(df.limit(0)).collect() == []


# op9, op1


def test_language(spark, odd):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = queries.op9_language(spark, "/root/testdata/sf0.01").collect()
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 4 == 2) for g in got)
    held = [g for g in got if g.held_out]
    assert sum(g.lang_pred == truth[g.doc_id] for g in held) >= 0.97 * len(held)
    model = language.train(docs)
    found = rows_of(language.identify(odd, model))
    assert len(found) == odd.count() and all(0 <= s <= 1 for *_, s in found)
    assert [lang for i, lang, _ in found if i in (0, 1, 2)] == ["und"] * 3
    assert language.identify(odd.limit(0), model).count() == 0
    assert {r.lang_pred for r in language.identify(odd, language.train(odd.limit(0))).collect()} == {"und"}
    assert language.in_a_language(odd, model).columns == odd.columns
    unlearned = language.in_a_language(odd, language.train(odd.limit(0))).collect()
    assert Counter(r.text for r in unlearned) == Counter(r.text for r in odd.collect() if language.has_letter(r.text))
    whole = "uno dos tres " * (language.CHUNK // 8)
    assert abs(float((language.features(whole) ** 2).sum()) - 1) < 1e-4


def test_quality(spark, odd):
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    got = queries.op1_quality(spark, folder).collect()
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 5 == 0) for g in got)
    assert all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.3) for g in got)
    held = [(g.score, g.predicted, truth[g.doc_id]) for g in got if g.held_out and g.doc_id in truth]
    good, bad = [h for h in held if h[2]], [h for h in held if not h[2]]
    assert sum(h[1] for h in good) >= 0.97 * len(good) and sum(not h[1] for h in bad) >= 0.9 * len(bad)
    model = quality.train(table(spark, folder, "documents"), table(spark, folder, "labels"))
    assert 0.75 < model.prior < 0.95  # 0.87 of the labelled rows are good
    assert quality.score(odd, model).count() == odd.count()
    assert quality.score(odd.limit(0), model).count() == 0
    assert {r.score for r in quality.score(odd, quality.train(odd, table(spark, folder, "labels").limit(0))).collect()} == {0.5}


# op10


def test_seeds_meet_every_two_substitutions():
    from itertools import combinations

    for bad in combinations(range(15), 2):
        assert any(not any(at + i in bad for i, c in enumerate(m) if c == "1")
                   for m in contamination.MASKS for at in range(15 - len(m) + 1))


def test_contamination(spark, odd):
    bench = table(spark, FOLDER, "benchmark").collect()
    clean = "nothing of the kind occurs here and words go on for a while without any meaning at all "
    rows, want = [], set()
    for i, item in enumerate(bench):
        words = item.text.split()
        rows.append((i, clean + item.text + " " + clean))
        words[len(words) // 2] = "other"
        rows.append((1000 + i, clean + re.sub("[a-z]+", lambda m: m[0].upper(), " ".join(words)) + " end"))
        want |= {(i, item.item_id), (1000 + i, item.item_id)}
        rows.append((2000 + i, clean + " ".join(words[:6])))
    rows += [(None, bench[0].text), (5000, None), (5001, ""), (5002, bench[1].text), (5002, bench[1].text)]
    want |= {(None, bench[0].item_id), (5002, bench[1].item_id)}
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, item_id int, start int")
    items = table(spark, FOLDER, "benchmark")
    for block in (contamination.BLOCK_WORDS, 300):
        got = contamination.find_overlaps(docs, items, block)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == want
        left = contamination.without_overlaps(docs, items, block)
        assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {d for d, _ in rows} - {d for d, _ in want}
    assert contamination.find_overlaps(docs.limit(0), items).count() == 0
    assert contamination.find_overlaps(docs, items.limit(0)).count() == 0
    assert contamination.find_overlaps(odd, items).count() == 0
    long = [i.text for i in bench] * 300  # one item longer than a piece
    one = spark.createDataFrame([(1, " ".join(f"{t} {n}" for n, t in enumerate(long)))], "item_id long, text string")
    assert contamination.find_overlaps(docs.where("doc_id < 20"), one).count() == min(20, len(bench))


def test_contamination_before_a_heavily_substituted_part():
    """Twenty exact words count, whatever follows them on the same diagonal; every stretch is tried."""
    own = contamination.word_hashes(" ".join(f"w{i}" for i in range(80)))
    block = contamination.Block([(7, 0, own)])
    kept = "T" * 20 + "TTFTTFTTTF" * 6
    text = " ".join(f"w{i}" if k == "T" else f"other{i}" for i, k in enumerate(kept))
    found = list(block.overlaps(contamination.word_hashes(text)))
    assert [f[:3] for f in found] == [(7, 0, 0)] and found[0][4] >= 20 and found[0][4] >= 0.8 * found[0][3]
    rng = np.random.default_rng(6)
    for _ in range(300):
        equal = rng.random(int(rng.integers(0, 40))) < rng.choice([0.5, 0.7, 0.8])
        spans = [(int(equal[a:b].sum()), a, b) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1)]
        most = max((n for n, a, b in spans if 5 * n >= 4 * (b - a)), default=0)
        begin, end = contamination._most_equal(equal)
        assert equal[begin:end].sum() == most and 5 * most >= 4 * (end - begin)


def test_documents_that_hold_an_item(spark):
    docs, items = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "benchmark")
    texts, found = items.collect(), {(r.doc_id, r.item_id) for r in contamination.find_overlaps(docs, items).collect()}
    holders = {(d.doc_id, i.item_id) for d in docs.collect() for i in texts if i.text in d.text}
    assert holders and holders <= found


# op4


def brute_resolve(rows):
    out = []
    for r in rows:
        if not r["is_revisit"]:
            continue
        earlier = [x for x in rows if not x["is_revisit"] and r["url"] and x["url"] == r["url"] and r["captured"] is not None
                   and x["captured"] is not None and x["captured"] < r["captured"]]
        if not earlier:
            out.append((r["record_id"], None, "none", None, None))
            continue
        hit = max(earlier, key=lambda x: (x["captured"], x["record_id"]))
        verdict = "unverified"
        for v in ("etag", "last_modified", "digest"):
            a, b = r[v], hit[v]
            if a is not None and b is not None:
                strip = (lambda s: s.removeprefix("W/")) if v == "etag" else (lambda s: s)
                verdict = v if strip(a) == strip(b) else "mismatch"
                break
        sure = verdict in ("etag", "last_modified", "digest")
        low = lambda h: {k.lower(): v for k, v in sorted((h or {}).items())}
        headers = {**low(hit["headers"]), **{k: v for k, v in low(r["headers"]).items() if k not in revisits.NOT_UPDATED}}
        out.append((r["record_id"], hit["record_id"], verdict, sorted(headers.items()) if sure else None, hit["digest"] if sure else None))
    return sorted(out, key=repr)


def test_revisits(spark):
    shape = ("record_id long, url string, captured long, is_revisit boolean, etag string, last_modified string, digest string, "
             "headers map<string,string>, verdict int, near string")
    rows = []
    for i in range(400):
        rows.append((i, "hot.org/a" if i % 3 else f"u{i % 7}.org", i // 2, i % 4 == 1, [None, '"a"', 'W/"a"', '"b"'][i % 5 % 4],
                     [None, "mon"][i % 2], [None, "d1", "d2"][i % 3], {"ETag": str(i), "Content-Length": "5", "X-A": "1"} if i % 6 else None))
    rows += [(500, None, 9, True, None, None, None, None), (501, "hot.org/a", None, True, '"a"', None, None, {}),
             (502, "hot.org/a", 300, True, None, None, None, {"X-a": "1", "x-A": "2"}), (502, "hot.org/a", 300, True, None, None, None, {"X-a": "1", "x-A": "2"}),
             (503, "hot.org/a", 301, None, None, None, "d9", {"Server": "s"})]
    names = ("record_id", "url", "captured", "is_revisit", "etag", "last_modified", "digest", "headers")
    got = revisits.resolve(spark.createDataFrame([(*r, 1, "n") for r in rows], shape))
    assert sorted(((r.record_id, r.refers_to, r.verdict, None if r.headers is None else sorted(r.headers.items()), r.digest)
                   for r in got.collect()), key=repr) == brute_resolve([dict(zip(names, r)) for r in rows])
    assert revisits.resolve(spark.createDataFrame([], shape)).count() == 0
    log = revisits.capture_log(table(spark, "/root/testdata/sf0.1", "pages"))
    plain = [r.asDict() for r in log.withColumn("url", revisits.canonical_url(F.col("url"))).collect()]
    found = revisits.resolve(log).collect()
    assert sorted(((r.record_id, r.refers_to, r.verdict, None if r.headers is None else sorted(r.headers.items()), r.digest)
                   for r in found), key=repr) == brute_resolve(plain)
    assert {"etag", "none", "mismatch"} <= {r.verdict for r in found}


def test_canonical_urls(spark):
    alike = ["http://www.A.org/x/?b=2&a=1", "https://a.org:443/x?a=1&b=2&utm_source=q#top", "a.org/x?a=1&&b=2&ref=x"]
    df = spark.createDataFrame([(u,) for u in [*alike, None]], "u string").select(revisits.canonical_url(F.col("u")).alias("c"))
    assert {r.c for r in df.collect()} == {"a.org/x?a=1&b=2", None}


# op2


def brute_rotate(rows):
    out, chats = {}, defaultdict(list)
    for conv, turn, role, text in rows:
        chats[conv].append((turn is not None, turn or 0, "unknown" if role is None else role, text or ""))
    for conv, said in chats.items():
        for who in {s[2] for s in said}:
            whole, learned = "", []
            for _, _, speaker, text in sorted(said, key=lambda s: s[:3]):
                whole += "<|assistant|>\n" if speaker == who else f"<|user name={speaker}|>\n"
                at = len(whole)
                whole += text + "<|end|>\n"
                if speaker == who:
                    learned.append((at, len(whole)))
            out[conv, who] = (whole, learned)
    return out


@pytest.mark.parametrize("part", [50, 16384])
def test_perspectives(spark, part):
    rows = [tuple(r) for r in table(spark, FOLDER, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(9000, i, "abc"[i % 3], f"turn {i} é") for i in range(500)]
    rows += [(9001, None, None, None), (9001, 1, "", ""), (9001, 1, "z", "y" * 5000), (None, 1, "a", "lost"), (9002, 2, "q", "twice"), (9002, 2, "q", "twice")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "conv_id long, turn long, role string, text string, part int, speaker string")
    made = defaultdict(list)
    for r in perspectives.rotate(df, part).collect():
        made[r.conv_id, r.assistant].append(r)
    want = brute_rotate(rows)
    assert set(made) == set(want)
    for key, parts in made.items():
        parts.sort(key=lambda r: r.start)
        assert "".join(p.text for p in parts) == want[key][0]
        assert [(p.start + s.content, p.start + s.end) for p in parts for s in p.spans if s.learned] == want[key][1]
    assert perspectives.rotate(df.limit(0)).count() == 0

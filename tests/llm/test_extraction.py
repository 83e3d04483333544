"""Main text of pages against the paragraphs that the pages were made from."""

import html
import re
import time

import pytest

from marlstone.llm import extraction, queries

FOLDER = "/root/testdata/sf0.001"
GIVEN = {"": 1.0}


def plain(page):
    """Blocks between the article tags of the test tables, by patterns that only fit these."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [html.unescape(re.sub(r"<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", inner))]
    return "\n".join(" ".join(b.split()) for b in blocks if b.split())


def test_query_against_plain_patterns(spark):
    rows = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = queries.op13_main_text(spark, FOLDER)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (rows[r.page_id].url, plain(rows[r.page_id].html), len(r.text))


def test_best_region_by_all_slices():
    import random
    rng = random.Random(3)
    for _ in range(500):
        scores = [rng.choice([-4, -2, -1, 0, 1, 2, 3]) for _ in range(rng.randint(0, 12))]
        a, b = extraction.best_region(scores)
        most = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)), default=0)
        assert sum(scores[a:b]) == max(0, most)


def counted(*pages):
    from collections import Counter
    total = Counter()
    for p in pages:
        total.update(extraction.counts_of(p))
    return total


def test_weights():
    page = "<html><body><div><a>one</a> two</div><article><p>a b c d</p><p>e f</p></article><div>three</div></body></html>"
    counts = counted(page)
    assert counts["", True] == 6 and counts["", False] == 3 and counts["p", True] == 2 and counts["/article", False] == 1
    w = extraction.weights(counts)
    assert w[""] > 0 and all(v < 0 for k, v in w.items() if k)
    assert w["article"] < w["p"] and w["div"] < w["p"]
    assert extraction.weights({}) == GIVEN
    assert not counted("<p>x</p>", "<article>a</article><article>b</article>", "<article>never closed")


ARTICLE = "The first paragraph of the text has several words. " * 3


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("only words here", "only words here"),
    ("<p>a &lt;b&gt; &amp; c&nbsp;d &copy &#233; &am</p>", "a <b> & c d © é &am"),
    ("<p>one\n\ttwo<br>three<p>four <b>five</b>six", "one two three\nfour fivesix"),
    ("<script>var a='<p>no</p>';</script><p>yes yes</p><!-- <p>no</p> --><style>p{}</style>", "yes yes"),
    ("<p title='a>b' data-x=\"<p>\">yes</p>", "yes"), ("<p class=x'y>it's</p>", "it's"),
    ("1 < 2 <3 and a<b", "1 < 2 <3 and a"), ("x <!--> y <!---> z", "x y z"),
    ("<p>text</p><!-- never closed <p>no</p>", "text"), ("<script>never closed <p>no", ""), ("good <a href='never closed", "good"),
])
def test_markup(page, text):
    assert extraction.main_text(page, GIVEN | {t: -0.01 for t in ("p", "/p", "b", "/b", "br")}) == text


@pytest.mark.parametrize("other", [
    "<nav><p>{0}</p></nav>", "<div class=header>{0}</div>", "<footer>{0}</footer>", "<aside><div>{0}</div>{0}</aside>",
    "<div class='ad'>{0}<div>{0}</div></div>", "<section class=\"x post-comments\"><p>{0}</p></section>", "<div id=cookie-notice>{0}</div>",
    "<form><label>{0}</label><select><option>{0}</select></form>", "<div role=navigation>{0}</div>", "<p class=ad>{0}",
    "<noscript>{0}</noscript>", "<template>{0}</template>", "<ul class='menu main-menu'><li>{0}<ul><li>{0}</ul></ul>",
])
def test_other_elements(other):
    """Long texts of other elements before, after and inside the article."""
    other = other.format("Words of something else, many more than the text has. " * 20)
    article = f"<article><h1>Title</h1>%s<p>{ARTICLE}</p></article>"
    want = "Title\n" + " ".join(ARTICLE.split())
    weight = extraction.weights(counted(*[f"<body>{other}{article % ''}</body>"] * 5))
    for page in (other + article % "", article % "" + other, article % other):
        if "=header" in other and page == article % other:
            continue  # an article's own header is text
        assert extraction.main_text(f"<html><body class='has-sidebar'>{page}</body></html>", weight) == want


def test_text_without_article_and_wrappers():
    labelled = [f"<body><ul><li><a>Home</a></li><li><a>News</a></li></ul><article><h1>T</h1><p>{ARTICLE}</p></article><div>c</div></body>"] * 9
    weight = extraction.weights(counted(*labelled))
    page = f"<body><ul><li><a>Home</a></li><li><a>Misc</a></li></ul><div id=x><h1>T</h1><p>{ARTICLE}</p><p>{ARTICLE}</p></div><div>end</div>"
    assert extraction.main_text(page, weight) == "\n".join(["T", *[" ".join(ARTICLE.split())] * 2])
    assert extraction.main_text(f"<form><nav>x</nav><article><p>{ARTICLE}</p></article></form>", weight) == " ".join(ARTICLE.split())
    assert extraction.main_text(f"<header>x y</header><article><header><h1>{ARTICLE}</h1></header><p>{ARTICLE}</p></article>", weight).count("\n") == 1


def test_long_pages_are_linear():
    for page in ("<a " * 300000, "<a x=\"" * 300000, "<!--" * 300000, "<" * 600000, "<script>" * 200000, "&" * 300000, "<p>a</p>" * 200000,
                 "<div class=ad>" * 100000, "<p " + "class " * 200000 + ">a"):
        start = time.perf_counter()
        extraction.main_text(page, GIVEN)
        assert time.perf_counter() - start < 10


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<p>x</p>"), (2, "u", "<p>x</p>"), (2, "u", "<p>x</p>")]
    df = spark.createDataFrame([(*r, 5, 0.5) for r in rows], "page_id long, url string, html string, text int, n_chars double")
    got = sorted((tuple(r) for r in extraction.extract(df).collect()), key=repr)
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (None, "v", "x", 1), (2, "u", "x", 1), (2, "u", "x", 1)], key=repr)
    assert extraction.extract(df.limit(0)).count() == 0

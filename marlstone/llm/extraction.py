"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is read as a sequence of words and tags. Words score positive, tags
negative, and one linear scan finds the contiguous region of the highest sum,
which is widened to whole blocks.

The weights come from labelled pages: those that hold exactly one ``<article>``
(or, without one, exactly one ``<main>``). Over all of them, words and tags are
counted inside and outside that element; a weight is the logarithm of the two
smoothed shares, kept from ``LEAST_WORD`` to ``WORD`` for words and below 0 for
tags. Tags that never stand inside, the element's own first of all, so part
regions. Tags that no labelled page has weigh ``TAG``, and without labelled pages
all weights are ``WORD`` and ``TAG``.

Elements that are not the page's text by their name, role or class (menus,
adverts, scripts, comments of readers, ...) have neither words nor tags, in
learning as in the scan: they neither join a region nor part one, and nothing of
them is in the result.

Markup is read as browsers do: comments, quoted attributes, and raw text of
scripts end where HTML ends them, an open ``<p>`` ends at the next block, and a
construct that never ends reaches to the end of the page. Every step is linear.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = 1.0
TAG = -3.25
#: The smallest sizes of learned weights.
LEAST_WORD, LEAST_TAG = 0.1, 0.01

# Names of HTML elements and what they mean for the text.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot "
    "th thead tr ul".split())
INLINE = frozenset(
    "a abbr acronym audio b bdi bdo big br button canvas cite code data datalist del dfn em embed font i iframe img input ins kbd "
    "label map mark meter object output picture progress q rp rt ruby s samp select slot small span strike strong sub sup svg time "
    "tt u var video wbr".split())
ELEMENTS = BLOCK | INLINE | RAW | VOID
ASIDE = frozenset("aside button canvas dialog footer form head iframe menu nav noscript object option search select svg template".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager "
    "pagination popup promo promotion related share sharing sidebar signup skyscraper social sponsor sponsored subscribe toolbar "
    "topbar".split())
#: A class such as ``has-sidebar`` describes what else is on the page.
ELSEWHERE = frozenset("has is no not with without".split())
NEVER = frozenset("html body article main h1 h2 h3 h4 h5 h6 b br em i strong".split())

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)"
    r"|<(?=[!?/])[^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)", re.S)
_ATTRIBUTE = re.compile(r"(?<![^\s/\"'])(class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s\"'>]++))", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_PARTS = re.compile(r"[^\W_]+")


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) of a page in order; kinds are ``text``, ``open`` and ``close``. Raw text is left out."""
    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.match(page, at)
        at = found.end()
        text = found["text"]
        if text is not None:
            yield "text", text, ""
        elif found["name"] is not None:
            name = found["name"].lower()
            if found["close"]:
                yield "close", name, ""
                continue
            yield "open", name, found["attributes"]
            if name in RAW:
                end = _RAW_END[name].search(page, at)
                at = end.start() if end else size


def is_aside(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is no part of the text by its name, role or class. An article's own header is."""
    if name in RAW or name in ASIDE:
        return True
    if name in NEVER or name in VOID:
        return False
    if name == "header":
        return not in_article
    if "=" in attributes:
        for key, *values in _ATTRIBUTE.findall(attributes):
            value = "".join(values).lower()
            if key.lower() == "role":
                if value.strip() in ROLES:
                    return True
                continue
            for word in value.split():
                parts = _PARTS.findall(word)
                if parts and parts[0] not in ELSEWHERE:
                    ends = {parts[0], parts[-1]} & MARKS
                    if ends - ({"header"} if in_article else set()):
                        return True
    return False


def outline(page: str) -> list[tuple[str, str, bool]]:
    """The events of a page as (kind, name or text, whether it lies in an element that is no part of the text)."""
    out = []
    zone, depth, articles = None, 0, 0
    for kind, name, attributes in events(page):
        if kind == "text":
            out.append((kind, name, zone is not None))
            continue
        if zone is not None:
            if zone == "p" and name in BLOCK and (kind == "open" or name != "p"):
                zone = None  # a paragraph ends at the next block
            elif kind == "open" and name in ("article", "main") and not articles and zone not in ("aside", "template"):
                zone = None  # a form or wrapper around the text itself
            elif name == zone:
                depth += 1 if kind == "open" else -1
                if depth == 0:
                    zone = None
                    out.append((kind, name, True))
                    continue
        if zone is None:
            if name in ("article", "main"):
                articles = max(0, articles + (1 if kind == "open" else -1))
            elif kind == "open" and name not in VOID and is_aside(name, attributes, articles > 0):
                zone, depth = name, 1
        out.append((kind, name, zone is not None))
    return out


def feature(kind: str, name: str) -> str:
    """What has a weight of its own: opening and closing tags of each known element, all others together."""
    return ("/" if kind == "close" else "") + (name if name in ELEMENTS or name in ASIDE else "other")


def counts_of(page: str) -> Counter:
    """Counts of (feature, inside) over a labelled page; empty for a page without a label. Words are the feature ````."""
    seen = outline(page)
    for label in ("article", "main"):
        opened = [i for i, (kind, name, aside) in enumerate(seen) if kind == "open" and name == label and not aside]
        closed = [i for i, (kind, name, aside) in enumerate(seen) if kind == "close" and name == label and not aside]
        if opened:
            break
    if len(opened) != 1 or len(closed) != 1 or closed[0] < opened[0]:
        return Counter()
    counts = Counter()
    for i, (kind, name, aside) in enumerate(seen):
        if aside:
            continue
        inside = opened[0] < i < closed[0]
        if kind == "text":
            counts["", inside] += len(name.split())
        else:
            counts[feature(kind, name), inside] += 1
    return counts


def _count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        total = Counter()
        for page in part.column("html").to_pylist():
            if page:
                total.update(counts_of(page))
        keys = list(total)
        yield pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()),
                               pa.array([total[k] for k in keys], pa.int64())], names=["feature", "inside", "n"])


def learn(pages: DataFrame) -> dict[str, float]:
    """The weight of words (``""``) and of every tag, from all labelled pages of ``pages`` (``html``).

    Counts are added up in the tasks first; what reaches the driver is bounded by
    the number of HTML elements.
    """
    counted = pages.select("html").mapInArrow(_count, "feature string, inside boolean, n long")
    rows = counted.groupBy("feature", "inside").agg(F.sum("n").alias("n")).collect()
    return weights({(r.feature, r.inside): r.n for r in rows})


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Logarithms of smoothed shares inside against outside; without both kinds of evidence the given ones."""
    features = sorted({f for f, _ in counts} | {""})
    sums = {side: sum(n for (_, s), n in counts.items() if s == side) for side in (True, False)}
    if not sums[True] or not sums[False]:
        return {"": WORD}
    out = {}
    for f in features:
        share = {side: (counts.get((f, side), 0) + 0.5) / (sums[side] + 0.5 * len(features)) for side in (True, False)}
        log = math.log(share[True] / share[False])
        out[f] = min(WORD, max(LEAST_WORD, log)) if f == "" else min(-LEAST_TAG, log)
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """The first slice of the highest positive sum, (0, 0) if there is none; one pass."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, region = total, (start, i + 1)
    return region


def whole_blocks(items: list[tuple[str, str]], first: int, last: int) -> tuple[int, int]:
    """The region, widened to the ends of its first and last block so that an inline tag cuts no sentence."""
    if first == last:
        return first, last
    while first and (items[first - 1][0] == "text" or items[first - 1][1] not in BLOCK):
        first -= 1
    while last < len(items) and (items[last][0] == "text" or items[last][1] not in BLOCK):
        last += 1
    return first, last


def main_text(page: str | None, weight: dict[str, float]) -> str:
    """The blocks of the best region of a page, one a line, white space within a block as one blank."""
    if not page:
        return ""
    items = [(kind, html.unescape(name) if kind == "text" else name) for kind, name, aside in outline(page) if not aside]
    word = weight[""]
    scores = [word * len(name.split()) if kind == "text" else weight.get(feature(kind, name), TAG) for kind, name in items]
    first, last = whole_blocks(items, *best_region(scores))
    blocks, block = [], []
    for kind, name in items[first:last]:
        if kind == "text":
            block.append(name)
        elif name in BLOCK:
            blocks.append("".join(block))
            block = []
        elif name == "br":
            block.append(" ")
    blocks.append("".join(block))
    lines = [" ".join(b.split()) for b in blocks]
    return "\n".join(line for line in lines if line)


def _extract(weight: dict[str, float]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [main_text(page, weight) for page in part.column("html").to_pylist()]
            yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, weight: dict[str, float] | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id``, ``url``, ``html``; others are ignored).

    ``weight`` is from ``learn``, by default over the same pages. ``n_chars``
    counts code points. A null or empty page, and one without a word outside the
    elements that are left out, has an empty text. Of equal regions the first
    counts. Repeated rows are rows of their own; rows are never moved.
    """
    weight = learn(pages) if weight is None else weight
    fields = [pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return pages.select("page_id", "url", "html").mapInArrow(_extract(weight), T.StructType(fields))

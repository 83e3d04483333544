"""Dictionary entities with offsets and sentence.

A phrase matches in exact case between token boundaries. Where matches overlap,
the one with more tokens wins, then the one that starts first. All phrases are
looked for in one pass over a text, by an automaton built once in each task. Only
rows that contain some phrase reach Python.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.functions.text import SENTENCE_GAP
from marlstone.operators.patterns import Finder

# The domain phrases by label.
PHRASES = {
    "PENSION_FUND": (
        "pension fund", "pension funds", "pensioenfonds", "bedrijfstakpensioenfonds", "ABP", "PFZW", "PMT",
        "BpfBOUW", "Pensioenfonds Zorg en Welzijn", "Algemeen Burgerlijk Pensioenfonds",
    ),
    "REGULATION": (
        "IORP II", "IORP III", "IORP", "FTK", "Financieel Toetsingskader", "Wet toekomst pensioenen", "WTP",
        "SFDR", "Sustainable Finance Disclosure Regulation", "Pension Schemes Act",
    ),
    "METRIC": (
        "coverage ratio", "coverage ratios", "dekkingsgraad", "beleidsdekkingsgraad", "funding ratio",
        "funding level", "solvency ratio", "technical provisions", "vereist eigen vermogen",
    ),
    "REQUIREMENT": (
        "recovery plan", "herstelplan", "ORSA", "Own Risk and Solvency Assessment", "prudent person principle",
        "prudent person rule", "prudent person", "ESG integration", "ESG reporting", "fit and proper",
        "fit-and-proper", "governance review", "annual ORSA",
    ),
}
# A number (digits or word), an optional percent sign, "coverage ratio" in any case.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million "
    "billion trillion"
).split()
NUMBERED_RATIO = (
    r"(?i:(?<!\w)(?:\d+(?:[.,/]\d+)*|" + "|".join(NUMBER_WORDS) + r")\s*%?\s*(?<!\w)coverage\s+ratio(?!\w))"
)
TOKEN_PATTERNS = {"METRIC": (NUMBERED_RATIO,)}

# Entity label to node label.
NODE_LABELS = {
    "PENSION_FUND": "PensionFund",
    "REGULATION": "Regulation",
    "METRIC": "Concept",
    "REQUIREMENT": "Requirement",
}

ENTITY = "struct<text:string,label:string,start_char:int,end_char:int,sentence:string>"
_TOKEN = re.compile(r"\w+|[^\w\s]")


class Phrases:
    """An automaton over the phrases of a dictionary, which may name one phrase under several labels."""

    def __init__(self, phrases: list[tuple[str, str]]):
        self.texts = sorted({p for p, _ in phrases})
        self.labels = [[label for p, label in phrases if p == text] for text in self.texts]
        self.finder = Finder(self.texts)

    def matches(self, text: str):
        for end, place in self.finder.spans(text):
            at = end - len(self.texts[place])
            before, after = text[at - 1:at] if at else "", text[end:end + 1]
            if not (before.isalnum() or before == "_" or after.isalnum() or after == "_"):
                for label in self.labels[place]:
                    yield at, end, label


def _matches(text: str, phrases: Phrases, patterns: list[tuple[re.Pattern, str]]):
    yield from phrases.matches(text)
    for pattern, label in patterns:
        for m in pattern.finditer(text):
            yield m.start(), m.end(), label


def find_entities(text: str, phrases: Phrases,
                  patterns: list[tuple[re.Pattern, str]]) -> list[tuple[int, int, str]]:
    """Chosen ``(start, end, label)`` spans in text order."""
    found = set(_matches(text, phrases, patterns))
    ordered = sorted(found, key=lambda m: (-len(_TOKEN.findall(text[m[0]:m[1]])), m[0], -m[1], m[2]))
    taken: list[tuple[int, int, str]] = []
    used = bytearray(len(text)) if found else bytearray()
    for start, end, label in ordered:
        if not any(used[start:end]):
            used[start:end] = b"\x01" * (end - start)
            taken.append((start, end, label))
    return sorted(taken)


def _with_sentences(text: str, spans: list[tuple[int, int, str]]) -> list[dict]:
    ends = [m.start() for m in re.finditer(SENTENCE_GAP, text)] + [len(text)]
    out, s, begin = [], 0, 0
    for start, end, label in spans:
        while ends[s] <= start:
            begin, s = ends[s], s + 1
        stop = next(e for e in ends[s:] if e >= end)
        out.append({"text": text[start:end], "label": label, "start_char": start, "end_char": end,
                    "sentence": text[begin:stop].strip()})
    return out


def entities(text: Column, phrases: dict[str, tuple[str, ...]] = PHRASES,
             patterns: dict[str, tuple[str, ...]] = TOKEN_PATTERNS) -> Column:
    """``array<struct<text,label,start_char,end_char,sentence>>`` of a text column."""
    words = [(p, label) for label, group in phrases.items() for p in group]
    sources = [(p, label) for label, group in patterns.items() for p in group]

    @F.pandas_udf(f"array<{ENTITY}>")
    def extract(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compiled, automaton = [(re.compile(p), label) for p, label in sources], Phrases(words)
        for texts in parts:
            yield texts.map(lambda t: _with_sentences(t, find_entities(t, automaton, compiled)))

    return extract(text)


def extract_entities(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     phrases: dict[str, tuple[str, ...]] = PHRASES,
                     patterns: dict[str, tuple[str, ...]] = TOKEN_PATTERNS,
                     labels: list[str] | None = None) -> DataFrame:
    """One row per entity: ``key, text, label, start_char, end_char, sentence``."""
    quoted = "|".join(r"\Q" + p + r"\E" for group in phrases.values() for p in group)
    numbered = [r"(?i)coverage\s+ratio"] if patterns is TOKEN_PATTERNS else [
        p for group in patterns.values() for p in group]
    maybe = F.lit(False)
    for p in ([quoted] if quoted else []) + numbered:
        maybe = maybe | F.col(text).rlike(p)
    found = docs.filter(maybe).select(key, F.explode(entities(F.col(text), phrases, patterns)).alias("e"))
    out = found.select(key, "e.*")
    return out if labels is None else out.filter(F.col("label").isin(labels))


def batch_extract(docs: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """Each document with a 120-character preview and its entities as an array."""
    phrases = kw.get("phrases", PHRASES)
    patterns = kw.get("patterns", TOKEN_PATTERNS)
    return docs.select(key, tx.snippet(text, 120, always=False).alias("preview"),
                       entities(F.col(text), phrases, patterns).alias("entities"))


def entity_texts_by_label(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Distinct entity texts per document and label with their first position."""
    return found.groupBy(key, "label", "text").agg(F.min("start_char").alias("first_at"),
                                                   F.count("*").alias("mentions"))


def entity_nodes(found: DataFrame, node_labels: dict[str, str] = NODE_LABELS) -> DataFrame:
    """Graph nodes of entities whose label has a node label: ``label, id, name, props``."""
    pairs = [F.lit(x) for kv in node_labels.items() for x in kv]
    label = F.try_element_at(F.create_map(*pairs), F.col("label"))
    return (
        found.select(label.alias("label"), F.lit(None).cast("string").alias("id"), F.col("text").alias("name"))
        .filter(F.col("label").isNotNull()).distinct()
        .withColumn("props", F.create_map(F.lit("source"), F.lit("spacy_extract")))
    )

"""Text expressions.

Blanks are ``\\s`` of the JVM (tab, line feed, vertical tab, form feed, carriage
return, space); a no-break space counts as a letter, unlike in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTENCE_GAP = r"(?<=[.!?])\s+"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def words(col: Column | str) -> Column:
    """Blank-separated words, case kept."""
    return F.filter(F.split(_c(col), r"\s+"), lambda w: w != "")


def tokens(col: Column | str) -> Column:
    """Lower-case blank-separated words; punctuation stays on the word."""
    return words(F.lower(_c(col)))


def word_count(col: Column | str) -> Column:
    return F.size(words(col))


def token_estimate(col: Column | str) -> Column:
    """Model tokens from words: a token is about three quarters of a word."""
    return F.ceil(word_count(col) / F.lit(0.75)).cast("long")


def strip(col: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(col), r"^\s+", ""), r"\s+$", "")


def has_content(col: Column | str) -> Column:
    return _c(col).rlike(r"\S")


def sentences(col: Column | str) -> Column:
    """Sentences end at ``.``, ``!`` or ``?`` followed by blanks."""
    return F.filter(F.split(_c(col), SENTENCE_GAP), lambda s: s.rlike(r"\S"))


def snippet(col: Column | str, size: int = 120, always: bool = True) -> Column:
    """The first ``size`` characters and ``...`` (only for longer text if not ``always``)."""
    cut = F.concat(F.substring(_c(col), 1, size), F.lit("..."))
    return cut if always else F.when(F.length(_c(col)) > size, cut).otherwise(_c(col))


def contains_ignore_case(haystack: Column | str, needle: Column | str) -> Column:
    """Substring test that is false, not null, when either side is missing."""
    return F.coalesce(F.contains(F.lower(_c(haystack)), F.lower(_c(needle))), F.lit(False))


def first_group(col: Column | str, pattern: str, default: Column | str | None = None) -> Column:
    """Group 1 of the first match; no match gives ``default``."""
    found = F.nullif(F.regexp_extract(_c(col), pattern, 1), F.lit(""))
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def chunk_number(col: Column | str) -> Column:
    """The integer of ``chunk_<n>``; null when it cannot be parsed."""
    return F.try_element_at(F.split(_c(col), "_"), F.lit(2)).try_cast("long")


def headed_passage(source: Column, article: Column, body: Column) -> Column:
    """``[source — article]`` (or ``[source]``) on a line above the passage."""
    tail = F.when(F.coalesce(article, F.lit("")) != "", F.concat(F.lit(" — "), article)).otherwise("")
    return F.concat(F.lit("["), F.coalesce(source, F.lit("unknown")), tail, F.lit("]\n"), body)


PASSAGE_RULE = "\n\n---\n\n"


def graph_line(name: Column, label: Column, rel: Column, direction: Column) -> Column:
    """``- name (label) [relationship / direction]`` with ``?`` for what is missing."""
    known = lambda c: F.coalesce(c, F.lit("?"))
    return F.format_string("- %s (%s) [%s / %s]", known(name), known(label), known(rel), known(direction))


def compact_stamp(ts: Column) -> Column:
    """UTC stamp such as ``20250131T235959Z`` (the session zone must be UTC)."""
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def iso_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def spans(col: Column | str, pattern: str) -> Column:
    """All matches with offsets: ``array<struct<value,start,end>>``, 0-based, end excluded.

    The text between the matches and the matches themselves come from the same
    scan rule of the JVM's regex engine, so running sums of their lengths are
    the offsets. ``pattern`` must not match the empty string.
    """
    gaps = F.split(_c(col), pattern, -1)
    hits = F.regexp_extract_all(_c(col), F.lit(pattern), F.lit(0))
    sizes = F.transform(hits, lambda h, i: F.struct(
        h.alias("value"), F.length(F.get(gaps, i)).alias("gap"), F.length(h).alias("len")))
    start = F.struct(
        F.lit(0).alias("pos"),
        F.array().cast("array<struct<value:string,start:int,end:int>>").alias("out"),
    )
    return F.aggregate(
        sizes,
        start,
        lambda acc, h: F.struct(
            (acc["pos"] + h["gap"] + h["len"]).alias("pos"),
            F.array_append(
                acc["out"],
                F.struct(
                    h["value"].alias("value"),
                    (acc["pos"] + h["gap"]).alias("start"),
                    (acc["pos"] + h["gap"] + h["len"]).alias("end"),
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )

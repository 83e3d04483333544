"""Finding and redacting personal data in columns and texts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.operators.ranking import top_k
from marlstone.session import staged

# Columns whose personal data is intended, confidence from which a
# hit counts, examples kept per finding.
ALLOWED_COLUMNS = ("counterparty_email", "counterparty_iban", "analyst_email")
MIN_CONFIDENCE = 0.6
MAX_EXAMPLES = 3
SNIPPET_MARGIN = 15


@dataclass(frozen=True)
class Detector:
    """A pattern for an entity type; ``check`` names a validator for each match.

    Every match holds one of the ``marks``, so a text without any is not searched.
    """

    entity: str
    pattern: str
    confidence: float
    check: str | None = None
    marks: tuple[str, ...] = ()

    def found_in(self, text: Column) -> Column:
        hit = text.rlike(self.pattern)
        if not self.marks:
            return hit
        marked = reduce(lambda a, b: a | b, [F.contains(text, F.lit(m)) for m in self.marks])
        return marked & hit


EMAIL = Detector("EMAIL_ADDRESS", r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", 1.0,
                 marks=("@",))
PHONE = Detector(
    "PHONE_NUMBER",
    r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,4}|\(\d{3}\) ?\d{3}-\d{4}", 0.75, marks=("+", "("))
IBAN = Detector(
    "IBAN_CODE",
    r"\b[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b", 1.0, "mod97")
DATE_TIME = Detector(
    "DATE_TIME", r"\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2})?)?|\d{1,2}[/.]\d{1,2}[/.]\d{4}", 0.85)
DETECTORS = (EMAIL, PHONE, IBAN, DATE_TIME)


def gazetteer(entity: str, names: list[str], confidence: float = 0.85) -> Detector:
    """A detector for listed names (persons, places, nationalities), longest first."""
    words = "|".join(r"\Q" + n + r"\E" for n in sorted(names, key=lambda n: (-len(n), n)))
    return Detector(entity, rf"(?U)\b(?:{words})\b", confidence)


def iban_is_valid(value: Column) -> Column:
    """ISO 13616 check: country and check digits to the end, letters as numbers, remainder 1 modulo 97."""
    plain = F.regexp_replace(value, r"\s", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(acc: Column, ch: Column) -> Column:
        digit = F.ascii(ch) - 48
        letter = F.ascii(ch) - 55
        return F.when(digit <= 9, (acc * 10 + digit) % 97).otherwise((acc * 100 + letter) % 97)

    chars = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0), step) == 1


_CHECKS = {"mod97": iban_is_valid}


def _by_entity(detectors: tuple[Detector, ...], min_confidence: float) -> dict[str, list[Detector]]:
    groups: dict[str, list[Detector]] = {}
    for d in detectors:
        if d.confidence >= min_confidence:
            groups.setdefault(d.entity, []).append(d)
    return groups


def matches(text: Column, detector: Detector) -> Column:
    """All valid matches of a detector as ``array<string>``."""
    found = F.regexp_extract_all(text, F.lit(detector.pattern), F.lit(0))
    return F.filter(found, _CHECKS[detector.check]) if detector.check else found


def redact_one(text: Column, detector: Detector) -> Column:
    """The text with the detector's matches replaced by ``<ENTITY>``."""
    mark = F.lit(f"<{detector.entity}>")
    if detector.check is None:
        return F.regexp_replace(text, detector.pattern, f"<{detector.entity}>")
    return F.aggregate(matches(text, detector), text, lambda acc, m: F.replace(acc, m, mark))


def redact(text: Column, detectors: tuple[Detector, ...] = DETECTORS,
           min_confidence: float = MIN_CONFIDENCE) -> Column:
    """The text with all personal data replaced, detectors in the given order."""
    use = [d for d in detectors if d.confidence >= min_confidence]
    return reduce(redact_one, use, text)


def any_match(text: Column, detectors: tuple[Detector, ...]) -> Column:
    """A cheap test before the matches are taken apart."""
    return reduce(lambda a, b: a | b, [d.found_in(text) for d in detectors], F.lit(False))


def cell_hits(cells: DataFrame, detectors: tuple[Detector, ...] = DETECTORS,
              min_confidence: float = MIN_CONFIDENCE, value: str = "value") -> DataFrame:
    """One row per cell and entity type found: ``..., entity_type, confidence_min, confidence_max, example``."""
    text, groups = F.col(value), _by_entity(detectors, min_confidence)
    kept = [c for c in cells.columns if c != value]
    return _cell_entities(cells, groups, value).select(
        *kept, "f.*", _example(text, F.col("f.entity_type"), groups).alias("example"))


def _cell_entities(cells: DataFrame, groups: dict[str, list[Detector]], value: str) -> DataFrame:
    """The cells once for each entity type found in them, with ``f(entity_type, confidence_min, confidence_max)``.

    A pattern is looked for once; only matches that a validator judges are taken out.
    """
    text, found = F.col(value), []

    def seen(d: Detector) -> Column:
        hit = d.found_in(text)
        return F.when(hit, F.size(matches(text, d)) > 0) if d.check else hit

    for entity, group in groups.items():
        scores = F.array_compact(F.array(*[F.when(seen(d), F.lit(d.confidence)) for d in group]))
        found.append(F.struct(F.lit(entity).alias("entity_type"), scores.alias("scores")))
    some = F.filter(F.array(*found), lambda f: F.size(f["scores"]) > 0)
    return cells.withColumn("f", F.explode(F.transform(some, lambda f: F.struct(
        f["entity_type"].alias("entity_type"), F.array_min(f["scores"]).alias("confidence_min"),
        F.array_max(f["scores"]).alias("confidence_max")))))


def _example(text: Column, entity: Column, groups: dict[str, list[Detector]]) -> Column:
    """The text redacted by the detectors of one entity type."""
    return F.coalesce(*[F.when(entity == name, reduce(redact_one, group, text)) for name, group in groups.items()])


def table_cells(df: DataFrame, columns: list[str], file_path: Column, row_pos: Column) -> DataFrame:
    """``(file_path, row_pos, column_name, value)``: non-empty stripped cells."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column_name"), tx.strip(F.col(c).cast("string")).alias("value")) for c in columns])
    return df.select(file_path.alias("file_path"), row_pos.alias("row_pos"), F.explode(cells).alias("c")).select(
        "file_path", "row_pos", "c.column_name", "c.value").filter(F.coalesce(F.col("value"), F.lit("")) != "")


def column_findings(cells: DataFrame, detectors: tuple[Detector, ...] = DETECTORS,
                    min_confidence: float = MIN_CONFIDENCE,
                    allowed_columns: tuple[str, ...] = ALLOWED_COLUMNS) -> DataFrame:
    """Findings per file, column and entity type; counts are rows.

    The examples are the first three rows. The patterns run over all cells once;
    what that pass keeps is a few columns per hit. The texts are read again only for
    the rows that stand first.
    """
    groups = _by_entity(detectors, min_confidence)
    group = ["file_path", "column_name", "entity_type"]
    hits = staged(_cell_entities(cells, groups, "value").select("file_path", "column_name", "row_pos", "f.*"))
    counts = _counted(hits, allowed_columns)
    first = top_k(hits.select(*group, "row_pos"), MAX_EXAMPLES, F.col("row_pos"), per=tuple(group)).groupBy(*group).agg(
        F.max("row_pos").alias("_last"))  # null only if no row of the first has a place
    wanted = staged(first)
    rows = cells.join(wanted, ["file_path", "column_name"]).filter(
        F.col("row_pos").isNull() | (F.col("row_pos") <= F.col("_last")))
    same = F.col("f.entity_type") == F.col("entity_type")
    shown = _cell_entities(rows, groups, "value").filter(same).select(
        *group, "row_pos", _example(F.col("value"), F.col("entity_type"), groups).alias("example"))
    shown = top_k(shown, MAX_EXAMPLES, F.col("row_pos"), F.col("example"), per=tuple(group))
    examples = shown.groupBy(*group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "example"))), lambda e: e["example"])
        .alias("example_values"))
    return counts.join(examples, group).select(
        "file_path", "file_type", "column_name", "entity_type", "row_count_with_pii", "example_values", "allowed",
        "confidence_min", "confidence_max")


def _counted(hits: DataFrame, allowed_columns: tuple[str, ...]) -> DataFrame:
    counts = hits.groupBy("file_path", "column_name", "entity_type").agg(
        F.count("*").alias("row_count_with_pii"), F.min("confidence_min").alias("confidence_min"),
        F.max("confidence_max").alias("confidence_max"))
    allowed = F.lower("column_name").isin([c.lower() for c in allowed_columns])
    return counts.withColumns({"file_type": F.lit("csv"), "allowed": allowed})


def column_counts(cells: DataFrame, detectors: tuple[Detector, ...] = DETECTORS,
                  min_confidence: float = MIN_CONFIDENCE,
                  allowed_columns: tuple[str, ...] = ALLOWED_COLUMNS) -> DataFrame:
    """``column_findings`` without examples: one pass, nothing but counts is shuffled."""
    hits = _cell_entities(cells, _by_entity(detectors, min_confidence), "value")
    return _counted(hits.select("file_path", "column_name", "f.*"), allowed_columns).filter(
        F.col("file_path").isNotNull() & F.col("column_name").isNotNull())


def text_findings(docs: DataFrame, detectors: tuple[Detector, ...] = DETECTORS,
                  min_confidence: float = MIN_CONFIDENCE, file_path: str = "file_path",
                  text: str = "text") -> DataFrame:
    """Findings per text and entity type; counts are spans, examples show 15 characters around a span.

    A text is one row, so everything happens inside the row without a shuffle.
    """
    body = F.col(text)
    empty = F.array().cast("array<struct<value:string,start:int,end:int,confidence:double>>")
    found = []
    for entity, group in _by_entity(detectors, min_confidence).items():
        def valid(d: Detector) -> Column:
            all_ = tx.spans(body, d.pattern)
            ok = F.filter(all_, lambda s: _CHECKS[d.check](s["value"])) if d.check else all_
            return F.transform(ok, lambda s: F.struct(
                s["value"].alias("value"), s["start"].alias("start"), s["end"].alias("end"),
                F.lit(d.confidence).alias("confidence")))

        spans = reduce(F.concat, [F.when(d.found_in(body), valid(d)).otherwise(empty) for d in group])
        found.append(F.struct(F.lit(entity).alias("entity_type"), F.array_sort(
            F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                  s["confidence"].alias("confidence")))).alias("spans")))
    rows = docs.filter(any_match(body, detectors)).select(
        F.col(file_path).alias("file_path"), body.alias("_t"), F.explode(F.array(*found)).alias("f")).filter(
        F.size("f.spans") > 0)

    def example(s: Column) -> Column:
        begin = F.greatest(s["start"] - SNIPPET_MARGIN, F.lit(0))
        return F.concat(
            F.col("_t").substr(begin + 1, s["start"] - begin),
            F.concat(F.lit("<"), F.col("entity_type"), F.lit(">")),
            F.col("_t").substr(s["end"] + 1, F.lit(SNIPPET_MARGIN)))

    rows = rows.select("file_path", "_t", "f.entity_type", "f.spans")
    scores = F.transform("spans", lambda s: s["confidence"])
    return rows.select(
        "file_path", F.lit("txt").alias("file_type"), F.lit(None).cast("string").alias("column_name"), "entity_type",
        F.size("spans").cast("long").alias("row_count_with_pii"),
        F.transform(F.slice("spans", 1, MAX_EXAMPLES), example).alias("example_values"),
        F.lit(False).alias("allowed"), F.array_min(scores).alias("confidence_min"),
        F.array_max(scores).alias("confidence_max"))


def scan_summary(findings: DataFrame) -> DataFrame:
    """One row: number of findings and whether any is not allowed."""
    return findings.agg(F.count("*").alias("total_findings"),
                        F.coalesce(F.bool_or(~F.col("allowed")), F.lit(False)).alias("unexpected_pii_found"))


def findings_per_file(findings: DataFrame) -> DataFrame:
    return findings.groupBy("file_path").agg(
        F.count("*").alias("findings"), F.count_if(~F.col("allowed")).alias("unexpected"))


def status_table(findings: DataFrame) -> DataFrame:
    """Findings with ``ALLOWED`` or ``UNEXPECTED``, in file, column and entity order."""
    return findings.select(
        "file_path", F.coalesce("column_name", F.lit("(text)")).alias("column_name"), "entity_type",
        "row_count_with_pii", F.when(F.col("allowed"), "ALLOWED").otherwise("UNEXPECTED").alias("status"),
    ).orderBy("file_path", "column_name", "entity_type")

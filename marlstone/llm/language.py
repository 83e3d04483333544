"""Language identification in two steps: the family first, then the language within it.

Features are hashed byte n-grams of the whole text, lower-cased. A linear support
vector machine per family is set against all others; within a family one machine per
pair of languages votes. All are fitted on a bounded sample of labelled documents
(``SAMPLE`` in all, dealt evenly to the languages); scoring is a dot product per row.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import fold, join_safe
from marlstone.session import bounded_batches, staged

DIM, ORDERS = 4096, (1, 2, 3, 4)
SAMPLE = 4000  # labelled documents that the machines are fitted on, at most
HELD_OUT_FOLD, FOLDS = 2, 4
ROUNDS, PENALTY = 150, 1e-3
CHUNK = 1 << 20
UNKNOWN = "und"
# Families by language code; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
}


def family(language: str) -> str:
    code = language.split("-")[0].lower()
    return next((name for name, codes in FAMILIES.items() if code in codes), f"of {language}")


def features(text: str | None) -> np.ndarray:
    """Square roots of hashed n-gram counts, of length 1. Long texts are counted piece by piece."""
    data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(DIM, dtype=np.int64)
    reach = max(ORDERS)
    for at in range(0, len(data), CHUNK):
        part = data[at:at + CHUNK + reach - 1].astype(np.uint32)
        code = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, reach + 1):
            here = len(part) - n + 1
            if here <= 0:
                break
            code = (code[:here] << np.uint32(8)) | part[n - 1:]
            if n in ORDERS:
                own = min(here, CHUNK)  # windows that begin in the overlap belong to the next piece
                hashed = (code[:own] + np.uint32(n * 0x51ED270B & 0xFFFFFFFF)) * np.uint32(0x9E3779B1) >> np.uint32(20)
                counts += np.bincount(hashed, minlength=DIM)
    vector = np.sqrt(counts).astype(np.float32)
    return vector / max(float(np.linalg.norm(vector)), 1e-9)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Machine:
    """A linear support vector machine and the slope that turns its margin into a probability."""

    weights: np.ndarray
    bias: float
    slope: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x), -30, 30)))


def fit_machine(x: np.ndarray, positive: np.ndarray) -> Machine:
    """Squared hinge loss, both classes of equal weight, by accelerated gradient steps."""
    sign = np.where(positive, 1.0, -1.0).astype(np.float32)
    share = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1)).astype(np.float32)
    weights = ahead = np.zeros(x.shape[1] + 1, dtype=np.float32)
    for step in range(ROUNDS):
        short = np.maximum(0, 1 - sign * (x @ ahead[:-1] + ahead[-1])) * sign * share
        slope = np.append(-2 * (x.T @ short) + 2 * PENALTY * ahead[:-1], -2 * short.sum())
        moved = ahead - 0.2 * slope
        weights, ahead = moved, moved + step / (step + 3) * (moved - weights)
    margin = np.clip(sign * (x @ weights[:-1] + weights[-1]), -5, 5)
    slopes = np.linspace(0.5, 8, 16)
    loss = [float((share * np.logaddexp(0, -k * margin)).sum()) for k in slopes]
    return Machine(weights[:-1], float(weights[-1]), float(slopes[int(np.argmin(loss))]))


class LanguageModel:
    """Families against the rest, then pairs of languages within the family."""

    def __init__(self, x: np.ndarray, labels: list[str]):
        labels_ = np.array(labels, dtype=object)
        self.languages = sorted(set(labels))
        families = np.array([family(v) for v in labels], dtype=object)
        self.families = sorted(set(families))
        self.members = {f: [v for v in self.languages if family(v) == f] for f in self.families}
        self.of_family = ({f: fit_machine(x, families == f) for f in self.families} if len(self.families) > 1 else {})
        self.of_pair = {}
        for group in self.members.values():
            for a, b in combinations(group, 2):
                rows = (labels_ == a) | (labels_ == b)
                self.of_pair[a, b] = fit_machine(x[rows], labels_[rows] == a)

    def plain(self) -> dict:
        """Labels and weights as plain values, which ``restored`` takes."""
        machines = {name: {k: (m.weights, m.bias, m.slope) for k, m in getattr(self, name).items()} for name in ("of_family", "of_pair")}
        return {"languages": self.languages, "families": self.families, "members": self.members, **machines}

    @classmethod
    def restored(cls, plain: dict) -> LanguageModel:
        model = cls(np.zeros((0, DIM), dtype=np.float32), [])
        for name, value in plain.items():
            setattr(model, name, {k: Machine(*m) for k, m in value.items()} if name.startswith("of_") else value)
        return model

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(x)
        names, scores = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
        if not self.languages or not n:
            return list(names), scores
        if self.of_family:
            chance = np.stack([self.of_family[f].chance(x) for f in self.families], axis=1)
            chosen, total = chance.argmax(1), chance.sum(1)
            sure = chance.max(1) / np.maximum(total, 1e-9)
        else:
            chosen, sure = np.zeros(n, dtype=int), np.ones(n)
        for i, f in enumerate(self.families):
            rows, group = np.nonzero(chosen == i)[0], self.members[f]
            if not len(rows):
                continue
            votes, trust = np.zeros((len(rows), len(group))), np.zeros((len(rows), len(group)))
            for a, b in combinations(range(len(group)), 2):
                p = self.of_pair[group[a], group[b]].chance(x[rows])
                votes[:, a] += p >= 0.5
                votes[:, b] += p < 0.5
                trust[:, a] += p
                trust[:, b] += 1 - p
            best = (votes + trust / max(1, len(group))).argmax(1)
            names[rows] = np.array(group, dtype=object)[best]
            scores[rows] = sure[rows] * (trust[np.arange(len(rows)), best] / (len(group) - 1) if len(group) > 1 else 1.0)
        return list(names), np.clip(scores, 0, 1)


def training_rows(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``lang, text``: at most ``sample`` labelled documents outside the held-out fold, as many of each language."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
                       & (fold(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD))
    known = known.select("lang", "text", F.xxhash64("doc_id", "text").alias("_order"))
    counts = staged(known.groupBy("lang").agg(F.count("*").alias("n"), F.min("_order").alias("least")))
    each = max(1, sample // max(1, counts.count()))
    # the rows that come first have small hashes: only twice as many as wanted are shuffled, whatever the table's size
    reach = F.greatest(F.col("least").cast("double"), F.lit(-2.0 ** 63) + F.lit(2.0 ** 65 * each) / F.col("n"))
    some = join_safe(known, counts, ["lang"]).where(F.col("_order").cast("double") <= reach)
    place = Window.partitionBy("lang").orderBy("_order")
    return some.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= each).select("lang", "text")


def _fit(parts):
    """The model of all rows (``lang, places, values``) of one task, which are at most the sample, in an order of their own."""
    rows = [r for part in parts for r in zip(part.column(0).to_pylist(), *[
        [v.values.to_numpy() for v in part.column(i)] for i in (1, 2)])]
    rows.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))
    x = np.zeros((len(rows), DIM), dtype=np.float32)
    for at, (_, places, values) in enumerate(rows):
        x[at, places] = values
    yield pa.record_batch([pa.array([pickle.dumps(LanguageModel(x, [r[0] for r in rows]).plain())], pa.binary())], names=["model"])


def train(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """The machines, fitted in one task on the bounded sample; the driver receives their weights only."""
    def run(parts):
        for part in parts:
            vectors = [features(t.as_py()) for t in part.column(1)]
            places = [np.nonzero(v)[0].astype(np.int16) for v in vectors]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(places, pa.list_(pa.int16())),
                 pa.array([v[p] for v, p in zip(vectors, places)], pa.list_(pa.float32()))], names=["lang", "places", "values"])

    rows = training_rows(docs, sample).mapInArrow(run, "lang string, places array<short>, values array<float>")
    found = rows.repartition(1).mapInArrow(_fit, "model binary").first()
    return LanguageModel.restored(pickle.loads(found.model) if found else {})


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id") -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text; ``und`` and 0 for a null text or one without a letter.

    Other columns are ignored, repeated rows give repeated results, an empty table
    none. A model of no training rows predicts ``und``.
    """
    bounded_batches(docs.sparkSession)
    schema = docs.select(key).schema.add("lang_pred", "string").add("score", "double")

    def run(parts):
        for part in parts:
            names, scores = predicted(model, part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[key, "lang_pred", "score"])

    return docs.select(key, "text").mapInArrow(run, schema)


def predicted(model: LanguageModel, texts: pa.Array, step: int = 512) -> tuple[list[str], np.ndarray]:
    names, scores = [], []
    for at in range(0, len(texts), step):
        some = [t.as_py() for t in texts[at:at + step]]
        found, sure = model.predict(np.stack([features(t) for t in some]))
        letters = [has_letter(t) for t in some]
        names += [v if ok else UNKNOWN for v, ok in zip(found, letters)]
        scores.append(np.where(letters, sure, 0.0))
    return names, np.concatenate([*scores, np.zeros(0)])


def in_a_language(docs: DataFrame, model: LanguageModel, least: float = 0.0) -> DataFrame:
    """The documents whose language is known with a score of at least ``least``; columns stay as they are.

    Where no language could be learned, every document with a letter stays.
    """
    bounded_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(parts):
        for part in parts:
            if model.languages:
                names, scores = predicted(model, part.column(at))
                stays = [n != UNKNOWN and s >= least for n, s in zip(names, scores)]
            else:
                stays = [has_letter(t.as_py()) for t in part.column(at)]
            yield part.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

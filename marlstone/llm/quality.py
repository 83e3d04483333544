"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; all other documents are unlabelled web
text, good and bad mixed. The share of good ones among them (the class prior) is
estimated, and a linear model on features of the whole text minimises the
non-negative unbiased risk: ``prior * R(positive as good) + max(0, R(unlabelled as bad) -
prior * R(positive as bad))``. Labels of bad documents are not used.

The model is fitted on a bounded sample (``SAMPLE`` rows of each kind); features and
scores are computed row by row for all documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import fold

FOLDS, HELD_OUT_FOLD = 5, 0
SAMPLE = 6000  # positives and unlabelled rows that the model is fitted on, at most, of each
THRESHOLD = 0.3
HASHED = 64
ROUNDS, BATCHES, RATE, DECAY = 60, 12, 0.02, 1e-4
HELD_PART = 4  # one of so many positives is kept back to estimate the prior
BINS = 200
_SPLIT = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")


def features(text: str | None) -> np.ndarray:
    """Shares and scaled counts that describe how a text is built, and hashed kinds of its words."""
    text = text or ""
    words = text.split()
    n, chars = len(words), max(1, len(text))
    lines = [v for v in text.split("\n") if v.strip()]
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    bytes_ = np.bincount(data, minlength=256)
    letters = int(bytes_[65:91].sum() + bytes_[97:123].sum() + bytes_[0xC3:0xC6].sum())
    upper, digits = int(bytes_[65:91].sum()), int(bytes_[48:58].sum())
    marks = bytes_[[33, 35, 36, 37, 38, 42, 60, 62, 124]]  # ! # $ % & * < > |
    stops = int(bytes_[[44, 46, 58, 59, 63]].sum())
    kinds = Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n) if n else np.zeros(1, dtype=np.int64)
    pairs = sum(a == b for a, b in zip(words, words[1:]))
    threes = list(zip(words, words[1:], words[2:]))
    top = kinds.most_common(1)[0][1] if n else 0
    shares = [
        letters / chars, upper / max(1, letters), digits / chars, *(marks / max(1, n)), stops / max(1, n),
        len(kinds) / max(1, n), top / max(1, n), pairs / max(1, n), len(set(threes)) / max(1, len(threes)),
        len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)) / 50, float(lengths.mean()) / 10,
        float(lengths.std()) / 10, float(lengths.max()) / 50, np.log1p(n) / 10, (np.log1p(n) / 10) ** 2,
        len(kinds) / max(1, n) * np.log1p(n) / 10, n == 0, n < 5, n < 20, n < 50, float(sum(w.isupper() for w in words)) / max(1, n),
        float(sum(w.istitle() for w in words)) / max(1, n), sum(not any(map(str.isalnum, w)) for w in words) / max(1, n),
    ]
    hashed = np.zeros(HASHED)
    for w, count in kinds.items():
        hashed[zlib.crc32(w.lower().encode("utf-8", "surrogatepass")) % HASHED] += count
    vector = np.concatenate([np.sqrt(np.clip(np.array(shares, dtype=np.float64), 0, 4)), np.array(shares, dtype=np.float64).clip(0, 4),
                             np.sqrt(hashed / max(1, n))])
    return vector.astype(np.float32)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> QualityModel:
    """Non-negative risk with the logistic loss, in small batches with Adam."""
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    p, u = (np.clip((v - mean) / scale, -8, 8).astype(np.float64) for v in (positive, unlabelled))
    w = np.zeros(p.shape[1] + 1)
    m, v, step = np.zeros_like(w), np.zeros_like(w), 0
    rng = np.random.default_rng(seed)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    pull = lambda x, g: np.append(x.T @ g, g.sum()) / len(x)
    for _ in range(ROUNDS):
        for bp, bu in zip(np.array_split(rng.permutation(len(p)), BATCHES), np.array_split(rng.permutation(len(u)), BATCHES)):
            if not len(bp) or not len(bu):
                continue
            xp, xu = p[bp], u[bu]
            sp, su = sigmoid(xp @ w[:-1] + w[-1]), sigmoid(xu @ w[:-1] + w[-1])
            bad = -np.log(np.maximum(1 - su, 1e-12)).mean() - prior * -np.log(np.maximum(1 - sp, 1e-12)).mean()
            slope_bad = pull(xu, su) - prior * pull(xp, sp)
            slope = prior * pull(xp, sp - 1) + slope_bad if bad >= 0 else -slope_bad  # a negative risk is climbed out of
            slope[:-1] += DECAY * w[:-1]
            step += 1
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope ** 2
            w = w - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return QualityModel(mean, scale, w[:-1], float(w[-1]), prior)


def estimate_prior(held: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled rows from scores of both.

    Above a threshold at which nearly only positives are left, the share of unlabelled
    rows divided by that of positives is the prior; the threshold is the one with
    the smallest upper bound of that ratio.
    """
    edges = np.linspace(0, 1, BINS + 1)
    above = lambda s: np.cumsum(np.histogram(s, edges)[0][::-1])[::-1] / max(1, len(s))
    q_p, q_u = above(held), above(unlabelled)
    slack = np.sqrt(np.log(4 / 0.1) / 2 / max(1, len(held))) + np.sqrt(np.log(4 / 0.1) / 2 / max(1, len(unlabelled)))
    useful = q_p > 0.05
    bound = np.where(useful, (q_u + slack) / np.maximum(q_p, 1e-9), np.inf)
    at = int(np.argmin(bound))
    return float(np.clip(q_u[at] / max(q_p[at], 1e-9), 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> QualityModel | None:
    """A first model ranks the rows, the prior is read from its scores, the second one uses it."""
    if len(positive) < 2 or len(unlabelled) < 2:
        return None
    held = np.arange(len(positive)) % HELD_PART == 0
    first = _fit(positive[~held], unlabelled, 0.5)
    prior = estimate_prior(first.score(positive[held]), first.score(unlabelled))
    return _fit(positive, unlabelled, prior)


def _vectors(rows: DataFrame) -> DataFrame:
    def run(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([features(t.as_py()) for t in part.column(1)], pa.list_(pa.float32()))],
                names=["good", "x"])
    return rows.mapInArrow(run, "good boolean, x array<float>")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel | None:
    """Fit on documents outside the held-out fold: those with a label 1, and any at all as unlabelled.

    At most ``sample`` rows of each kind are taken, spread by a hash of the id. Without
    two of either there is no model.
    """
    open_ = docs.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD).select("doc_id", "text")
    good = labels.where((F.col("quality") == 1) & (fold(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD)).select("doc_id").distinct()
    n_open, n_good = open_.count(), good.count()

    def share(ids: DataFrame, n: int, salt: str) -> DataFrame:
        """About ``sample`` rows, the same ones in every run."""
        cut = int(min(1.0, 0.95 * sample / max(1, n)) * (1 << 30))
        return ids.where(F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 30)) < cut)

    picked = open_.join(share(good, n_good, "good"), "doc_id", "left_semi").select(F.lit(True).alias("good"), "text")
    mixed = share(open_, n_open, "open").select(F.lit(False).alias("good"), "text")
    found = [[], []]
    for part, rows in ((0, _vectors(picked)), (1, _vectors(mixed))):
        for row in rows.limit(sample).toLocalIterator():
            found[part].append(np.array(row.x, dtype=np.float32))
    return fit(*(np.stack(v) if v else np.zeros((0, 1), np.float32) for v in found))


def score(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """``doc_id, score`` of every whole text; without a model, 0.5.

    Null and empty texts are scored as a text of no words. Columns other than ``doc_id``
    and ``text`` are ignored; repeated rows give repeated results, an empty table none.
    """
    def run(parts):
        for part in parts:
            scores = [np.zeros(0)]
            for at in range(0, part.num_rows, 1024):
                texts = part.column(1)[at:at + 1024]
                scores.append(model.score(np.stack([features(t.as_py()) for t in texts])) if model else np.full(len(texts), 0.5))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.concatenate(scores), pa.float64())],
                                             names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, docs.select("doc_id").schema.add("score", "double"))

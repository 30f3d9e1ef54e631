"""Quality classifier by positive-unlabelled learning, without any negative label.

Trusted positives are documents labelled good; the unlabelled side is a sample
of all documents. A text becomes shape features (lengths, shares of character
classes, repetition), each cut at quantiles of the unlabelled sample; a linear
model on the cuts minimises the non-negative unbiased risk

    prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)])

with the logistic loss. The class prior is estimated from a first model that
tells positives from unlabelled texts: where a share q_p of held-aside
positives and q_u of held-aside unlabelled texts score above a cut, the prior
is at most q_u / q_p; it is taken where that bound with its sampling error is
least.

The fit uses at most SAMPLE positives and SAMPLE unlabelled documents, of at
most SAMPLE_CHARS characters, chosen by a hash of doc_id; only learning rows
give labels. Scoring covers every document and its whole text.

Defined results: null and empty texts have the features of an empty text and
are scored like any. Null labels, labels without a doc_id or a document are
ignored; a document with several label rows is good if all say so. Without
positives every score is 0.5. Repeated rows get equal scores.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_learning_row, one_per_id, text_of

SAMPLE = 8192
SAMPLE_CHARS = 65_536
CUTS = 12

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
SYMBOLS = b"#*$%&|<>@^~{}\\_=+"
MARKS = b".,;:!?"


def shape(text: str) -> list[float]:
    """Features of a whole text."""
    raw = text.encode()
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n, size = max(1, len(words)), max(1, len(raw))

    def share(characters: bytes) -> float:
        return (len(raw) - len(raw.translate(None, characters))) / size

    distinct = len(set(words))
    windows = len(set(zip(words, words[1:], words[2:])))
    same = sum(map(str.__eq__, words, words[1:]))
    ended = sum(1 for x in lines if x.rstrip()[-1] in ".!?\"'”…")
    return [
        math.log1p(len(words)), math.log1p(len(lines)), len(words) / max(1, len(lines)),
        sum(map(len, words)) / n, share(UPPER), share(DIGITS), share(SYMBOLS), share(MARKS), share(b"|"), share(b"!"),
        distinct / n, windows / max(1, len(words) - 2), same / n, len(set(lines)) / max(1, len(lines)),
        ended / max(1, len(lines)), raw.count(b"!!") / n,
    ]


@dataclass
class Model:
    """Cuts per feature, a weight per interval, the intercept and the estimated prior."""

    cuts: np.ndarray | None = None
    weights: np.ndarray | None = None
    bias: float = 0.0
    prior: float = 0.5

    def score(self, texts: list[str]) -> np.ndarray:
        if self.cuts is None or not texts:
            return np.full(len(texts), 0.5)
        odds = intervals(np.array([shape(t) for t in texts]), self.cuts) @ self.weights + self.bias
        return 1 / (1 + np.exp(-odds))


def intervals(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Above-the-cut indicators of every feature and cut."""
    return (values[:, :, None] > cuts[None, :, :]).reshape(len(values), -1).astype(np.float64)


def quantile_cuts(values: np.ndarray) -> np.ndarray:
    return np.quantile(values, np.linspace(0.01, 0.99, CUTS), axis=0).T.copy()


def _descend(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    at, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        slope = gradient(at)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope ** 2
        at = at - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
    return at


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def non_negative_fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float,
                     steps: int = 800, rate: float = 0.03, ridge: float = 1e-3) -> np.ndarray:
    """Weights, the intercept last, of least non-negative risk."""
    p = np.hstack([positive, np.ones((len(positive), 1))])
    u = np.hstack([unlabelled, np.ones((len(unlabelled), 1))])

    def gradient(w):
        on_p, on_u = p @ w, u @ w
        as_positive = -(p.T @ _sigmoid(-on_p)) / len(p)
        p_as_negative, u_as_negative = p.T @ _sigmoid(on_p) / len(p), u.T @ _sigmoid(on_u) / len(u)
        risk = np.logaddexp(0, on_u).mean() - prior * np.logaddexp(0, on_p).mean()
        negative = u_as_negative - prior * p_as_negative
        penalty = ridge * np.append(w[:-1], 0.0)
        # A negative estimate of the negatives' risk is fitted too well: step back from it.
        return penalty + (prior * as_positive + negative if risk >= 0 else -negative)

    return _descend(gradient, p.shape[1], steps, rate)


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores of texts that the scoring model
    has not seen: at the least upper bound, the lower end of two standard errors, as a
    prior that is too high takes negatives for positives."""
    cuts = np.quantile(positive, np.linspace(0.0, 0.9, 46))
    q_p = (positive[None, :] >= cuts[:, None]).mean(axis=1)
    q_u = (unlabelled[None, :] >= cuts[:, None]).mean(axis=1)
    error_u = 2 * np.sqrt(q_u * (1 - q_u) / len(unlabelled))
    error_p = 2 * np.sqrt(q_p * (1 - q_p) / len(positive))
    best = int(np.argmin((q_u + error_u) / np.maximum(q_p - error_p, 1e-9)))
    return float(np.clip((q_u[best] - error_u[best]) / (q_p[best] + error_p[best]), 0.01, 0.99))


def samples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(features, positive): the bounded samples. The ids sent to the scan are at most 2 * SAMPLE, and each gives one row."""
    good = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality"))
            .filter("id IS NOT NULL AND quality IN (0, 1)").filter(is_learning_row(F.col("id")))
            .groupBy("id").agg(F.min("quality").alias("quality")).filter("quality = 1")
            .orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id", F.lit(1).alias("positive")))
    others = (docs.select(F.col("doc_id").cast("long").alias("id")).filter("id IS NOT NULL")
              .distinct().orderBy(F.xxhash64("id", F.lit("unlabelled")), "id").limit(SAMPLE)
              .select("id", F.lit(0).alias("positive")))

    def run(batches):
        for batch in batches:
            values = [shape(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.list_(pa.float64())), batch.column(1)], names=["features", "positive"])

    return (one_per_id(docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text"))
                       .filter(F.length("text") <= SAMPLE_CHARS)
                       .join(F.broadcast(good.unionByName(others)), "id"), "positive")
            .mapInArrow(run, "features array<double>, positive int"))


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> Model:
    """The model of least non-negative risk; the prior is estimated unless it is given."""
    rows = sorted((r["positive"], tuple(r["features"])) for r in samples(docs, labels).collect())
    positive = np.array([x for p, x in rows if p])
    unlabelled = np.array([x for p, x in rows if not p])
    if not len(positive) or not len(unlabelled):
        return Model()
    shuffled = np.random.default_rng(0)
    positive, unlabelled = shuffled.permutation(positive), shuffled.permutation(unlabelled)
    cuts = quantile_cuts(unlabelled)
    p, u = intervals(positive, cuts), intervals(unlabelled, cuts)
    if prior is None:
        half_p, half_u = len(p) // 2, len(u) // 2
        if half_p and half_u:
            first = non_negative_fit(p[:half_p], u[:half_u], 0.5)
            prior = estimated_prior(p[half_p:] @ first[:-1], u[half_u:] @ first[:-1])
        else:
            prior = 0.5
    weights = non_negative_fit(p, u, prior)
    return Model(cuts, weights[:-1], float(weights[-1]), prior)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(batch.column(1).to_pylist()), pa.float64())],
                names=["doc_id", "score"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")

"""Toxicity by multiple-instance learning: a document is toxic if any sentence is.

Sentences are runs without `.`, `!`, `?` and line ends. A sentence's features
are its words and their five-letter beginnings, of a vocabulary of those that
toxic documents hold more often than chance allows. The chance p of a sentence
is a logistic function of its features; sentences without any have the chance
PLAIN. The document's score is the noisy-or 1 - prod(1 - p), and the weights
maximise the likelihood of the document labels under it. Sentences of p >= 0.5
are reported as offending, with their spans in code points.

The model is fitted on a bounded sample, at most SAMPLE labelled documents of
each label with at most SAMPLE_CHARS characters, weighted back to the label
counts. Scoring covers every document and its whole text.

Defined results: null and blank texts have no sentence with evidence and score
0. Labels that are null, without doc_id or of no document are ignored; a
document with several label rows is toxic if one says so. Without labels of
both kinds the vocabulary is empty and every score stays under the plain
chance. Repeated rows get equal scores; other columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_learning_row, one_per_id, text_of

SAMPLE = 8192           # labelled documents of each label in the fit
SAMPLE_CHARS = 65_536   # longest text in the fit
VOCABULARY = 4096       # features kept
COUNTED = 200_000       # features that a task counts before it hands them on
LEAST_G = 15.0          # log-likelihood ratio of a kept feature
LEAST_DOCS = 4          # toxic documents that hold it
PLAIN = -14.0           # log-odds of a sentence without evidence
BIAS = -4.0             # log-odds that evidence starts from
REJECT = 0.7            # score from which a document is called toxic

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
BEGINNING = 5


def features(sentence: str) -> set[str]:
    words = set(WORD.findall(sentence.lower()))
    return words | {w[:BEGINNING] + "*" for w in words if len(w) > BEGINNING}


@dataclass
class Model:
    """Weight per feature."""

    weights: dict[str, float] = field(default_factory=dict)

    def sentence_odds(self, sentence: str) -> float | None:
        """Log-odds of a sentence; None without evidence."""
        get = self.weights.get
        words = set(WORD.findall(sentence.lower()))
        found = [w for x in words if (w := get(x)) is not None]
        found += [w for x in {x[:BEGINNING] + "*" for x in words if len(x) > BEGINNING}
                  if (w := get(x)) is not None]
        return BIAS + sum(found) if found else None

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score and its offending sentences (start, end, p)."""
        safe, plain, offending = 0.0, 0, []
        for m in SENTENCE.finditer(text):
            odds = self.sentence_odds(m.group())
            if odds is None:
                plain += 1
                continue
            safe -= float(np.logaddexp(0.0, odds))
            if odds >= 0:
                offending.append((m.start(), m.end(), float(1 / (1 + np.exp(-odds)))))
        safe -= plain * float(np.logaddexp(0.0, PLAIN)) if offending or safe else 0.0
        return abs(float(-np.expm1(safe))), offending


@dataclass
class Bags:
    """Documents as bags of sentences with evidence, in flat arrays."""

    labels: np.ndarray     # per document
    importance: np.ndarray
    plain: np.ndarray      # sentences without evidence
    counts: np.ndarray     # different sentences with evidence
    times: np.ndarray      # per sentence: how often the document has it
    widths: np.ndarray     # features
    ids: np.ndarray        # the sentences' features, one after the other


def fit_noisy_or(bags: Bags, size: int, steps: int = 400, rate: float = 0.1, ridge: float = 2e-3) -> np.ndarray:
    """Weights that maximise the noisy-or likelihood of the documents' labels, by
    gradient steps with momentum and scaling."""
    weights = np.zeros(size)
    if not size or not len(bags.labels):
        return weights
    n, sentences = len(bags.labels), len(bags.times)
    importance = bags.importance / bags.importance.sum()
    base = -bags.plain * np.logaddexp(0.0, PLAIN)
    owner = np.repeat(np.arange(n), bags.counts)
    row = np.repeat(np.arange(sentences), bags.widths)
    first, second = np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        odds = BIAS + np.bincount(row, weights[bags.ids], minlength=sentences)
        p = 1 / (1 + np.exp(-odds))
        safe = base - np.bincount(owner, bags.times * np.logaddexp(0.0, odds), minlength=n)
        safe = np.minimum(safe, -1e-9)
        slope = np.where(bags.labels > 0, np.exp(safe) / -np.expm1(safe), -1.0) * importance
        by_sentence = -(slope[owner] * bags.times * p)
        gradient = np.bincount(bags.ids, by_sentence[row], minlength=size) + ridge * weights / n
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        weights = weights - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-12)
    return weights


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str) -> DataFrame:
    """(text, label, weight): the bounded learning sample for one label column.

    Only learning rows; of each label the SAMPLE first by a hash of doc_id.
    The ids that are sent to the scan are at most 2 * SAMPLE, and each gives one row.
    """
    rows = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col(target).cast("int").alias("label"))
            .filter("id IS NOT NULL AND label IN (0, 1)").filter(is_learning_row(F.col("id")))
            .groupBy("id").agg(F.max("label").alias("label")))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    parts = [rows.filter(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
             .withColumn("weight", F.lit(max(1.0, n / SAMPLE))) for y, n in sorted(counts.items())]
    chosen = parts[0].unionByName(parts[1]) if len(parts) == 2 else rows.limit(0).withColumn("weight", F.lit(1.0))
    return one_per_id(docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text"))
                      .filter(F.length("text") <= SAMPLE_CHARS)
                      .join(F.broadcast(chosen), "id"), "label", "weight")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model learned from the bounded sample of labelled documents."""
    sample = labelled_sample(docs, labels, "toxic")

    def counted(batches):
        def flushed():
            names = sorted(set(seen[0]) | set(seen[1]))
            return pa.RecordBatch.from_arrays(
                [pa.array([None, *names], pa.string())]
                + [pa.array([found[y], *(seen[y][x] for x in names)], pa.int64()) for y in (0, 1)],
                names=["feature", "clean", "toxic"])

        seen, found = {0: Counter(), 1: Counter()}, {0: 0, 1: 0}
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[label] += 1
                seen[label].update(features(text))
                if len(seen[0]) + len(seen[1]) >= COUNTED:
                    yield flushed()
                    seen, found = {0: Counter(), 1: Counter()}, {0: 0, 1: 0}
        yield flushed()

    counts = (sample.select("text", "label").mapInArrow(counted, "feature string, clean long, toxic long")
              .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    totals = counts.filter("feature IS NULL").first()
    if totals is None or not totals["clean"] or not totals["toxic"]:
        return Model()
    kept = _distinctive(counts.filter("feature IS NOT NULL"), totals["clean"], totals["toxic"])
    vocabulary = {r["feature"]: k for k, r in enumerate(kept.collect())}

    def bagged(batches):
        for batch in batches:
            plain, times, widths, flat = [], [], [], []
            for text in batch.column(0).to_pylist():
                none, bag = 0, Counter()
                for m in SENTENCE.finditer(text):
                    ids = tuple(sorted(vocabulary[x] for x in features(m.group()) if x in vocabulary))
                    if ids:
                        bag[ids] += 1
                    else:
                        none += 1
                plain.append(none)
                different = sorted(bag.items())
                times.append(np.array([k for _, k in different], "<i4").tobytes())
                widths.append(np.array([len(ids) for ids, _ in different], "<i4").tobytes())
                flat.append(np.array([x for ids, _ in different for x in ids], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(plain, pa.int64()),
                 *(pa.array(x, pa.binary()) for x in (times, widths, flat))],
                names=["label", "weight", "plain", "times", "widths", "ids"])

    rows = sorted((r["label"], bytes(r["ids"]), bytes(r["widths"]), bytes(r["times"]), r["plain"], r["weight"])
                  for r in sample.mapInArrow(bagged, "label int, weight double, plain long, times binary, "
                                                     "widths binary, ids binary").collect())

    def joined(k):
        return np.frombuffer(b"".join(r[k] for r in rows), "<i4")

    bags = Bags(np.array([r[0] for r in rows], float), np.array([r[5] for r in rows], float),
                np.array([r[4] for r in rows], float), np.array([len(r[3]) // 4 for r in rows], int),
                joined(3).astype(float), joined(2), joined(1).astype(int))
    weights = fit_noisy_or(bags, len(vocabulary))
    return Model({x: float(weights[k]) for x, k in vocabulary.items()})


def _distinctive(counts: DataFrame, clean: int, toxic: int) -> DataFrame:
    """The features with the largest log-likelihood ratio that speak for toxicity."""
    a, b = F.col("toxic"), F.col("clean")
    share = (a + b) / F.lit(clean + toxic)

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = 2 * (term(a, share * toxic) + term(b, share * clean)
                 + term(toxic - a, (1 - share) * toxic) + term(clean - b, (1 - share) * clean))
    return (counts.filter((a >= LEAST_DOCS) & (a * clean > b * toxic))
            .withColumn("g", ratio).filter(F.col("g") >= LEAST_G)
            .orderBy(F.desc("g"), "feature").limit(VOCABULARY).select("feature"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, offending array<struct<start, end, p>>) for every row."""
    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        for batch in batches:
            results = [model.score(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s for s, _ in results], pa.float64()),
                 pa.array([[{"start": a, "end": b, "p": p} for a, b, p in o] for _, o in results], kind)],
                names=["doc_id", "score", "offending"])

    return docs.select(F.col("doc_id"), text_of().alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, "
             "offending array<struct<start: int, end: int, p: double>>")


def clean_documents(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """The rows of `docs`, all columns, whose score is under `reject`."""
    model, at = fit(docs, labels), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array([model.score(text or "")[0] < reject
                                         for text in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

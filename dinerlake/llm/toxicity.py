"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence gets a logistic score of its words and word beginnings,
and the document is toxic if any sentence is: p = 1 - prod(1 - p_sentence), the noisy-or.  Only documents
carry labels; the sentence weights are learned through the noisy-or, and the sentences that carry the
decision are returned with their places.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dinerlake.llm.common import fold, written

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
LETTERS = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6)
THRESHOLD = 0.3

# Bounds of the fit: labelled documents, features, and the least evidence for a feature.
MAX_DOCUMENTS, MAX_FEATURES, MIN_CHI2 = 8_000, 4_096, 6.0

RESULT = "score double, sentences array<struct<start:int,end:int,score:double>>"


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


def training_ids(labels: DataFrame, bound: int) -> DataFrame:
    """doc_id and label of at most ``bound`` training documents, chosen by hash of the id."""
    return (
        labels.where(F.col("toxic").isin(0, 1) & (fold() != 2))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )


def count_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts = {0: Counter(), 1: Counter()}
        for text, label in zip(batch["text"], batch["toxic"], strict=True):
            words = set(LETTERS.findall(text.lower()))
            counts[label].update({f for w in words for f in features(w)})
        names = list(counts[0].keys() | counts[1].keys())
        yield pd.DataFrame({
            "feature": names,
            "toxic_docs": np.array([counts[1][f] for f in names], dtype=np.int64),
            "clean_docs": np.array([counts[0][f] for f in names], dtype=np.int64),
        })


def select_features(sample: DataFrame, most: int) -> list[str]:
    """The features whose document counts differ most between the labels."""
    toxic, clean = sample.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    if not toxic or not clean:
        return []
    counts = sample.mapInPandas(
        count_features, "feature string, toxic_docs long, clean_docs long"
    ).groupBy("feature").agg(F.sum("toxic_docs").alias("a"), F.sum("clean_docs").alias("b"))
    a, b, c, d = F.col("a"), F.col("b"), toxic - F.col("a"), clean - F.col("b")
    chi2 = (toxic + clean) * (a * d - b * c) ** 2 / (
        (a + b) * F.greatest(c + d, F.lit(1)) * float(toxic * clean))
    ranked = counts.where(a + b >= 2).select("feature", chi2.alias("chi2"))
    top = ranked.where(F.col("chi2") >= MIN_CHI2).orderBy(F.desc("chi2"), "feature").limit(most)
    return [row.feature for row in top.collect()]


def bags(known: dict[str, int]):
    """Per document: label, sentences without features, and for the others their features."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                plain, hits = 0, []
                for sentence in SENTENCE.findall(text):
                    words = set(LETTERS.findall(sentence.lower()))
                    found = [known[f] for w in words for f in features(w) if f in known]
                    if found:
                        hits.append(found)
                    else:
                        plain += 1
                out.append((int(label), plain, hits))
            yield pd.DataFrame(out, columns=["toxic", "plain", "hits"])
    return run


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def train(examples: list, n_features: int, rounds: int = 400, rate: float = 0.1,
          penalty: float = 1e-5) -> tuple[float, np.ndarray]:
    """Gradient descent (Adam) on the log-likelihood of the document labels."""
    label = np.array([e.toxic for e in examples], dtype=float)
    plain = np.array([e.plain for e in examples], dtype=float)
    lengths = [len(h) for e in examples for h in e.hits]
    doc = np.repeat(np.arange(len(examples)), [len(e.hits) for e in examples])
    sentence = np.repeat(np.arange(len(lengths)), lengths)
    feature = np.array([f for e in examples for h in e.hits for f in h], dtype=np.int64)
    theta = np.zeros(n_features + 1)
    theta[-1] = -7.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        bias = theta[-1]
        z = bias + np.bincount(sentence, theta[feature], minlength=len(lengths))
        clean = -(plain * softplus(bias) + np.bincount(doc, softplus(z), minlength=len(label)))
        clean = np.minimum(clean, -1e-9)  # log of the chance that no sentence is toxic
        slope = np.where(label == 1, np.exp(clean) / np.expm1(clean), 1.0)  # minus d loss / d clean
        by_sentence = slope[doc] / (1 + np.exp(-z))
        gradient = np.empty_like(theta)
        gradient[:-1] = np.bincount(feature, by_sentence[sentence], minlength=n_features)
        gradient[-1] = by_sentence.sum() + (slope * plain).sum() / (1 + np.exp(-bias))
        gradient /= len(label)
        gradient[:-1] += penalty * theta[:-1]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return float(theta[-1]), theta[:-1]


def fit(docs: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS,
        max_features: int = MAX_FEATURES) -> Model:
    """Learn from at most ``max_documents`` labelled documents outside the held-out fold.

    Rows with NULL id, text or label are not learned from; an id labelled twice counts as toxic
    if either row says so.  Without both labels the model scores every text 0.
    """
    ids = training_ids(labels, max_documents)
    sample = written(
        docs.where(F.col("text").isNotNull()).select("doc_id", "text")
        .join(F.broadcast(ids), "doc_id").select("text", "toxic"),
        "toxic-sample",
    )
    names = select_features(sample, max_features)
    if not names:
        return Model(-30.0, {})
    known = {name: i for i, name in enumerate(names)}
    examples = sample.limit(max_documents).mapInPandas(
        bags(known), "toxic int, plain int, hits array<array<int>>"
    ).collect()
    bias, weights = train(examples, len(names))
    return Model(bias, {n: float(w) for n, w in zip(names, weights, strict=True)})


class Scorer:
    """Scores texts in a task; word weights are looked up once per word."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}
        self.plain = float(softplus(np.float64(model.bias)))

    def weight(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 500_000:
                self.known.clear()
            found = sum(self.model.weights.get(f, 0.0) for f in features(word))
            self.known[word] = found
        return found

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        if not text:
            return 0.0, []
        carried = {w: x for w in set(LETTERS.findall(text.lower())) if (x := self.weight(w))}
        if not carried:
            count = len(SENTENCE.findall(text))
            return float(-np.expm1(-count * self.plain)), []
        log_clean, places = 0.0, []
        for match in SENTENCE.finditer(text):
            words = set(LETTERS.findall(match[0].lower()))
            z = self.model.bias + sum(carried[w] for w in words if w in carried)
            part = max(z, 0.0) + np.log1p(np.exp(-abs(z)))
            log_clean -= part
            p = float(-np.expm1(-part))
            if p >= THRESHOLD:
                places.append((match.start(), match.end(), p))
        return float(-np.expm1(log_clean)), places


def toxicity(model: Model, text: str = "text") -> Column:
    """Struct of ``score`` (0 to 1) and ``sentences``: start, end (code points, end exclusive) and
    score of each sentence of at least 0.3.  NULL and empty texts score 0.  Reads only the text."""
    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for texts in batches:
            yield pd.DataFrame([scorer.score(t) for t in texts], columns=["score", "sentences"])

    return run(F.col(text))

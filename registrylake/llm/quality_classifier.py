"""Text quality by regularised quadratic discriminant analysis.

Each text becomes a dozen statistics, transformed so that they spread evenly. Per label, the
mean and covariance of all labelled rows come from one aggregation of sums and products, of
a fixed number of values whatever the corpus. Covariances are shrunk towards the pooled one
and its diagonal, and factored once. The score is the logistic of the difference of the two
Gaussian log-densities, by Mahalanobis distances with the cached Cholesky factors.

Defined results
- A NULL text counts as empty; empty texts get a score like any other.
- Labels are learned from rows of ``labels`` with a 0 or 1 and a doc_id that is not held
  out; repeated label rows count as often as they occur. A class without rows gives all
  documents the score 0.5, or 0 or 1 if only the other class has rows.
- Rows without doc_id are scored, never learned from, and not held out.
- Empty documents give an empty result. Other columns play no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from registrylake.llm.shingles import small_batches
from registrylake.tables.work import staged

FEATURES = (
    "log_words",
    "mean_word",
    "symbols",
    "digits",
    "capitals",
    "stops",
    "commas",
    "distinct_words",
    "repeats",
    "duplicate_lines",
    "line_words",
    "other_marks",
)
SHRINK_TO_POOLED = 0.1
SHRINK_TO_DIAGONAL = 0.1
LEAST_VARIANCE = 1e-4
THRESHOLD = 0.3

_SYMBOLS = re.compile(r"[#*$%&|<>~^\\_={}\[\]]")
_DIGITS = re.compile(r"[0-9]")
_CAPITALS = re.compile(r"[A-Z]")
_STOPS = re.compile(r"[.!?](?=\s|$)")
_COMMAS = re.compile(r"[,;:](?=\s|$)")
_MARKS = re.compile(r"[!?\"'()/@+-]")


def _root(part: float, whole: float, usual: float, weight: float) -> float:
    """Square root of a share, drawn to a usual one as if ``weight`` more had been seen."""
    return math.sqrt((part + usual * weight) / (whole + weight))


def text_statistics(text: str) -> list[float]:
    """The transformed statistics of a text, in the order of ``FEATURES``.

    Shares of short texts say little, so they are drawn to what prose usually has.
    """
    words = text.split()
    n = len(words)
    chars = sum(map(len, words))
    count = lambda pattern: len(pattern.findall(text))
    lines = [line for line in text.split("\n") if line.strip()]
    triples = list(zip(words, words[1:], words[2:]))
    again = sum(c for c in Counter(triples).values() if c > 1)
    return [
        math.log(n + 20),
        math.log((chars + 100) / (n + 20)),
        _root(count(_SYMBOLS), chars, 0.0, 100),
        _root(count(_DIGITS), chars, 0.002, 200),
        _root(count(_CAPITALS), chars, 0.03, 200),
        _root(count(_STOPS), n, 0.1, 20),
        _root(count(_COMMAS), n, 0.06, 20),
        math.log(len(set(words)) + 20) / math.log(n + 20),
        _root(again, len(triples), 0.0, 40),
        _root(len(lines) - len(set(lines)), len(lines), 0.0, 6),
        math.log((n + 40) / (len(lines) + 2)),
        _root(count(_MARKS), chars, 0.002, 200),
    ]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        rows = [text_statistics(text or "") for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"]
        )


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: one id in five, by its CRC-32."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


@dataclass(frozen=True)
class Gaussian:
    """Mean and Cholesky factor of the covariance of a class, and its share of the rows."""

    prior: float
    mean: np.ndarray
    factor: np.ndarray

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = np.linalg.solve(self.factor, (x - self.mean).T)
        spread = 2 * np.log(np.diag(self.factor)).sum()
        return math.log(self.prior) - 0.5 * ((z * z).sum(axis=0) + spread)


@dataclass(frozen=True)
class Classifier:
    good: Gaussian | None
    bad: Gaussian | None

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability that the label is 1, per row."""
        if self.good is None or self.bad is None:
            value = 0.5 if self.good is self.bad else float(self.good is not None)
            return np.full(len(x), value)
        odds = self.good.log_density(x) - self.bad.log_density(x)
        return 1 / (1 + np.exp(np.clip(-odds, -60, 60)))


def fit_moments(moments: dict[int, tuple[int, np.ndarray, np.ndarray]]) -> Classifier:
    """From rows, sums and sums of products per label."""
    total = sum(n for n, _, _ in moments.values())
    k = len(FEATURES)
    means = {label: s / n for label, (n, s, _) in moments.items()}
    spread = {
        label: p / n - np.outer(means[label], means[label]) for label, (n, _, p) in moments.items()
    }
    pooled = sum((n * spread[label] for label, (n, _, _) in moments.items()), np.zeros((k, k)))
    pooled = pooled / max(1, total)

    def gaussian(label: int) -> Gaussian | None:
        if label not in moments:
            return None
        own = (1 - SHRINK_TO_POOLED) * spread[label] + SHRINK_TO_POOLED * pooled
        diagonal = np.diag(np.diag(own))
        own = (1 - SHRINK_TO_DIAGONAL) * own + SHRINK_TO_DIAGONAL * diagonal
        own += LEAST_VARIANCE * np.eye(k)
        return Gaussian(moments[label][0] / total, means[label], np.linalg.cholesky(own))

    return Classifier(gaussian(1), gaussian(0))


def fit(described: DataFrame, labels: DataFrame) -> Classifier:
    """From ``doc_id, x`` of documents and ``doc_id, quality`` of the labelled ones."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where(
        "label IN (0, 1)"
    )
    rows = described.join(known.where(~held_out(F.col("doc_id"))), "doc_id")
    k = len(FEATURES)
    x = [F.get("x", F.lit(i)) for i in range(k)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(k)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(k) for j in range(i, k)]
    moments = {}
    for row in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect():
        both = np.array([[row[f"p{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
        moments[row["label"]] = (row["n"], np.array([row[f"s{i}"] for i in range(k)]), both)
    return fit_moments(moments)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)``.

    ``score`` is the probability that ``labels.quality`` is 1; ``predicted`` is 1 from 0.3.
    """
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, x array<double>"
    described = staged(docs.select("doc_id", "text").mapInArrow(_describe, kind))
    model = fit(described, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(-1, len(FEATURES))
                scores = pa.array(model.score(x))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double"
    scored = described.mapInArrow(score, kind)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

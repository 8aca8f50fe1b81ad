"""Quality classifier: regularised quadratic discriminant over document statistics.

Every whole text is described by ``FEATURES``, transformed statistics of its
words, lines and characters (never its language, source or id). The labelled
training rows' sums (count, sum and cross products per class) are added up by
Spark over all of them. Each class covariance is shrunk towards the pooled one
and towards its own diagonal. The score is the logistic of the difference of the two
classes' log densities, from Mahalanobis distances with the Cholesky factors
computed once per model, over ``TEMPERATURE``.

Defined cases: a NULL or empty text has the statistics of no words and gets a
score like any other; a label that is NULL, or belongs to no document, teaches
nothing; repeated labels and rows count as often as they occur; without training rows
of both classes the score is the share of class 1, (n1 + 1) / (n + 2); an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, keep, prepared, text_groups

FEATURES = ("words", "word_length", "symbols", "capitals", "marks", "dup_lines", "distinct", "top_word", "same_next",
            "digits")
SHRINK_POOLED, SHRINK_DIAGONAL = 0.1, 0.1
#: Added to every variance, so that a statistic that is constant in a class stays invertible.
FLOOR = 0.05
TEMPERATURE = 1.0
KEEP_SCORE = 0.7


def statistics(text: str | None) -> tuple[float, ...]:
    """The transformed statistics of one text, in the order of FEATURES."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    m = max(n, 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    size = max(len(raw), 1)

    def count(chars: bytes) -> int:
        return len(raw) - len(raw.translate(None, chars))

    tally = Counter(words)
    return (float(np.log1p(n)), float(np.log((sum(map(len, words)) + 1) / m)), float(np.log1p(100 * count(b"#*$%&|<>") / m)),
            10.0 * count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / size, float(np.log1p(100 * count(b"!?;:=+~^_/\\") / m)),
            float(np.log1p(100 * (len(lines) - len(set(lines))) / m)),
            # distinct words against what n words of running text would have
            float(np.log((len(tally) + 1) / (m ** 0.8 + 1))), float(np.log1p(20 * max(tally.values(), default=0) / m)),
            float(np.log1p(100 * sum(map(eq, words, words[1:])) / m)), float(np.log1p(1000 * count(b"0123456789") / size)))


def described(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the array ``x`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_groups(batches):
            x = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))],
                                             ["doc_id", "x"])

    return prepared(docs, doc_id="bigint", text="string").mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Model:
    share: float  # of class 1 in training
    means: np.ndarray | None = None
    factors: np.ndarray | None = None  # Cholesky factors of the class covariances
    logdets: np.ndarray | None = None
    temperature: float = TEMPERATURE

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None or not len(x):
            return np.full(len(x), self.share)
        density = []
        for mean, factor, logdet in zip(self.means, self.factors, self.logdets, strict=True):
            y = np.linalg.solve(factor, (x - mean).T)
            density.append(-0.5 * ((y * y).sum(axis=0) + logdet))
        margin = (density[1] - density[0]) / self.temperature + np.log(self.share / (1 - self.share))
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))


def fit(labelled: DataFrame) -> Model:
    """Model from all rows of ``labelled (x, y)``, y in 0 and 1."""
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    x = [F.col("x")[i] for i in range(d)]
    rows = labelled.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in x]).alias("s"),
                                     F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("ss")).collect()  # two rows
    n = {r["y"]: r["n"] for r in rows}
    share = (n.get(1, 0) + 1) / (sum(n.values()) + 2)
    if min(n.get(0, 0), n.get(1, 0)) < 2:
        return Model(share)
    means, covs = np.zeros((2, d)), np.zeros((2, d, d))
    for r in rows:
        means[r["y"]] = np.array(r["s"]) / r["n"]
        for (i, j), v in zip(pairs, r["ss"], strict=True):
            covs[r["y"], i, j] = covs[r["y"], j, i] = v / r["n"] - means[r["y"], i] * means[r["y"], j]
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / (n[0] + n[1])
    shrunk = [(1 - SHRINK_POOLED - SHRINK_DIAGONAL) * c + SHRINK_POOLED * pooled
              + SHRINK_DIAGONAL * np.diag(np.diag(c)) + FLOOR * np.eye(d) for c in covs]
    factors = np.linalg.cholesky(np.array(shrunk))
    return Model(share, means, factors, 2 * np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1))


def held_out() -> Column:
    """The fold that is never learned from."""
    return fold(4) == 2


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows: statistics of labelled documents outside the held-out fold."""
    known = prepared(labels, doc_id="bigint", quality="int").where("quality in (0, 1)")
    return stats.where(~held_out()).join(known, "doc_id").select("x", F.col("quality").alias("y"))


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row of :func:`described`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(x), pa.float64())],
                                             ["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, keep_score: float = KEEP_SCORE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    stats = keep(described(docs))
    found = scored(stats, fit(labelled(stats, labels)))
    return found.select("doc_id", held_out().alias("held_out"), "score",
                        (F.col("score") >= keep_score).cast("int").alias("predicted"))

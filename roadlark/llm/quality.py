"""Quality classifier: regularised quadratic discriminant analysis of text statistics.

Each class is a normal distribution of transformed statistics of a document. Its
covariance is shrunk towards a multiple of the identity; the score is the posterior from
the difference of the two log-densities, whose Mahalanobis distances use the Cholesky
factors kept in the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from roadlark.llm.common import labelled_sample, lean, remainder, small_batches, text_of

FIT_DOCS = 20_000  # labelled documents the model is fitted on, at most
SHRINKAGE = 0.3
FOLDS = 5
ACCEPT = 0.3

_BYTES = np.arange(256)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_BEYOND = _BYTES >= 0x80
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_STOP = np.isin(_BYTES, list(b".,;:?'\"-()"))
_SPACE = np.isin(_BYTES, list(b" \t\r\n\x0b\x0c"))
_SYMBOL = ~(_LOWER | _UPPER | _BEYOND | _DIGIT | _STOP | _SPACE)
_CLASSES = np.stack([_UPPER, _BEYOND, _STOP, _SPACE, _SYMBOL]).astype(float)

# Every share starts from a little text of ordinary composition, so that a few words say little.
ORDINARY_BYTES = 200
ORDINARY = np.array([0.02, 0.04, 0.03, 0.17, 0.0])
ORDINARY_WORDS = 30
ORDINARY_LENGTH = 5.0
N_FEATURES = 9


def statistics(text: str) -> np.ndarray:
    """Transformed statistics of a whole text: smoothed shares of capitals, letters beyond
    ASCII, punctuation, space and other signs among its bytes; of words that end in a
    sign, are capitals or repeat the word before; the logarithm of the words' mean length.
    """
    data = text.encode("utf-8", "replace")
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    of_bytes = (_CLASSES @ seen + ORDINARY_BYTES * ORDINARY) / (len(data) + ORDINARY_BYTES)
    words = text.split()
    count = len(words) + ORDINARY_WORDS
    signs = sum(not w[-1].isalnum() and w[-1] not in ".,;:?" for w in words)
    capitals = sum(len(w) > 1 and w.isupper() for w in words)
    repeats = sum(map(str.__eq__, words, words[1:]))
    length = (sum(map(len, words)) + ORDINARY_WORDS * ORDINARY_LENGTH) / count
    return np.append(of_bytes, [signs / count, capitals / count, repeats / count, np.log(length)])


@dataclass
class Model:
    """Prior log-odds and, per class, mean, inverse Cholesky factor and log-determinant."""

    odds: float
    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_dets: list[float]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not self.means:
            difference = np.full(len(rows), self.odds)
        else:
            densities = [
                -0.5 * (np.square((rows - mean) @ factor.T).sum(axis=1) + log_det)
                for mean, factor, log_det in zip(self.means, self.factors, self.log_dets)
            ]
            difference = self.odds + densities[1] - densities[0]
        return 1 / (1 + np.exp(-np.clip(difference, -500, 500)))


def fit(sample: DataFrame, shrinkage: float = SHRINKAGE) -> Model:
    """The model of a (text, label) table. Without both labels it is the share of label 1,
    one half if there is no row."""

    @lean
    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                row = np.append(statistics(text), 1.0)
                sums[label] = sums.get(label, 0) + np.outer(row, row)
        for label, total in sums.items():
            yield pd.DataFrame({"label": label, "place": np.arange(total.size), "total": total.ravel()})

    partial = sample.mapInPandas(moments, "label int, place int, total double")
    rows = partial.groupBy("label", "place").agg(F.sum("total").alias("total")).collect()
    width = N_FEATURES + 1
    totals = {k: np.zeros(width * width) for k in (0, 1)}
    for label, place, total in rows:
        totals[1 if label else 0][place] += total
    counts = [totals[k][-1] for k in (0, 1)]
    odds = float(np.log((counts[1] + 0.5) / (counts[0] + 0.5)))
    if min(counts) < 1:
        return Model(odds, [], [], [])
    means, factors, log_dets = [], [], []
    for k in (0, 1):
        matrix = totals[k].reshape(width, width) / counts[k]
        mean = matrix[-1, :-1]
        covariance = matrix[:-1, :-1] - np.outer(mean, mean)
        spread = max(np.trace(covariance) / N_FEATURES, 1e-6)
        shrunk = (1 - shrinkage) * covariance + shrinkage * spread * np.eye(N_FEATURES)
        lower = np.linalg.cholesky(shrunk)
        means.append(mean)
        factors.append(np.linalg.inv(lower))
        log_dets.append(2 * float(np.log(np.diag(lower)).sum()))
    return Model(odds, means, factors, log_dets)


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Model:
    """Learns labels of documents outside the held-out fold, of ``fit_docs`` at most."""
    small_batches(docs)
    learn = remainder("doc_id", FOLDS) != 0
    sample = labelled_sample(docs, labels, "quality", learn, fit_docs)
    return fit(sample.withColumn("label", F.col("label").cast("int")))


def score(model: Model) -> Column:
    """Probability of label 1 of the column ``text``."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        rows = np.array([statistics(t) for t in texts]).reshape(-1, N_FEATURES)
        return pd.Series(model.scores(rows))

    return scored(text_of())


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    A null text is an empty one and is scored by the same densities. A null id is never
    labelled. Repeated rows get equal scores. Without labels every score is the share of
    label 1 known, 0.5 if none is. Other columns are not looked at.
    """
    model = train(docs, labels)
    rows = docs.select("doc_id", (remainder("doc_id", FOLDS) == 0).alias("held_out"), score(model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their columns."""
    return docs.where(score(train(docs, labels)) >= ACCEPT)

"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed n-grams that it has. Each is scaled by the logarithm of
the ratio of its smoothed shares in the two classes; a logistic regression over the scaled
features gives the score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, functions as F, types as T

from roadlark.llm.common import labelled_sample, lean, remainder, small_batches, text_of
from roadlark.session import materialise

FIT_DOCS = 20_000  # labelled documents the model is fitted on, at most
FOLDS = 3
HELD_OUT = 1
ACCEPT = 0.7
# Lengths, features and penalty have the fewest mistakes in a cross-validation inside the
# learning folds (README).
LENGTHS = (3, 4, 5, 6, 7)  # characters of an n-gram
HASH_BITS = 22
LEAST_DOCS = 5  # labelled documents an n-gram must be in
MOST_FEATURES = 1 << 11  # n-grams kept: those that tell the classes apart best
PENALTY = 1e-4
PIECES = 64  # that the counts of the buckets travel in

# One odd multiplier for each place of an n-gram.
_PLACES = np.random.default_rng(7).integers(1 << 62, 1 << 63, max(LENGTHS), np.uint64) * np.uint64(2) + np.uint64(1)


def ngrams(text: str) -> np.ndarray:
    """Hash bucket of every n-gram of the text, repeats included: lower case, one space
    for white space and around the text."""
    letters = f" {' '.join(text.lower().split())} "
    codes = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found, value = [], np.zeros(len(codes) + 1, np.uint64)
    for length in range(1, max(LENGTHS) + 1):
        if len(codes) < length:
            break
        value = value[:-1] + codes[length - 1 :] * _PLACES[length - 1]
        if length in LENGTHS:
            found.append(value >> np.uint64(64 - HASH_BITS))
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


@dataclass
class Model:
    """Weight of each n-gram bucket, most of them 0, and the constant."""

    buckets: np.ndarray
    weights: np.ndarray
    constant: float

    def table(self) -> np.ndarray:
        table = np.zeros(1 << HASH_BITS, np.float32)
        table[self.buckets] = self.weights
        return table


def log_count_ratios(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their ratios, for the n-grams that tell the classes apart best: by how
    far their counts in the two classes are from independence (likelihood ratio)."""

    size = (1 << HASH_BITS) // PIECES

    @lean
    def presence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, 1 << HASH_BITS), np.int32)
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                counts[1 if label else 0, np.unique(ngrams(text))] += 1
        if counts.any():
            pieces = np.split(counts, PIECES, axis=1)
            yield pd.DataFrame({"piece": range(PIECES), "counts": [zlib.compress(p.tobytes(), 1) for p in pieces]})

    def unpacked(blob: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(blob), np.int32).reshape(2, size)

    @lean
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, blob in zip(batch["piece"], batch["counts"]):
                sums[piece] = sums[piece] + unpacked(blob) if piece in sums else unpacked(blob)
        for piece, both in sums.items():
            yield pd.DataFrame({"piece": [piece], "counts": [zlib.compress(both.tobytes(), 1)]})

    partial = sample.mapInPandas(presence, "piece int, counts binary")
    counts = materialise(partial.repartition("piece").mapInPandas(add, partial.schema), "ngram-counts")

    @lean
    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for blob in batch["counts"]:
                both = unpacked(blob)
                clean, toxic = both.sum(axis=1, dtype=np.int64)
                yield pd.DataFrame({"clean": [clean], "toxic": [toxic], "distinct": [int(both.any(axis=0).sum())]})

    totals = counts.mapInPandas(whole, "clean long, toxic long, distinct long")
    clean, toxic, distinct = (x or 0 for x in totals.agg(F.sum("clean"), F.sum("toxic"), F.sum("distinct")).first())

    def surprise(seen: np.ndarray, total: int, both: np.ndarray) -> np.ndarray:
        return seen * np.log(np.maximum(seen, 1) / (both * (total / (clean + toxic))))

    @lean
    def telling(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for piece, blob in zip(batch["piece"], batch["counts"]):
                table = unpacked(blob)
                often = np.flatnonzero(table.sum(axis=0) >= LEAST_DOCS)
                fine, bad = table[:, often].astype(float)
                ratio = np.log((bad + 1) / (toxic + distinct)) - np.log((fine + 1) / (clean + distinct))
                tells = surprise(fine, clean, fine + bad) + surprise(bad, toxic, fine + bad)
                top = np.lexsort((often, -tells))[:MOST_FEATURES]
                yield pd.DataFrame({"bucket": piece * size + often[top], "ratio": ratio[top], "tells": tells[top]})

    best = (
        counts.mapInPandas(telling, "bucket int, ratio double, tells double")
        .orderBy(F.desc("tells"), "bucket")
        .limit(MOST_FEATURES)
        .orderBy("bucket")
        .collect()
    )
    return np.array([r["bucket"] for r in best], np.int64), np.array([r["ratio"] for r in best])


def fit(sample: DataFrame, penalty: float = PENALTY) -> Model:
    """The model of a (text, label) table. Without both labels it is the share of label 1,
    one half if there is no row."""
    clean, toxic = sample.agg(F.count(F.when(F.col("label") == 0, 1)), F.count(F.when(F.col("label") != 0, 1))).first()
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), float(np.log((toxic + 0.5) / (clean + 0.5))))
    if not clean or not toxic:
        return nothing
    buckets, ratios = log_count_ratios(sample)
    if not len(buckets):
        return nothing

    @F.udf(VectorUDT())
    def scaled(text: str) -> SparseVector:
        present = np.unique(ngrams(text))
        at = np.minimum(np.searchsorted(buckets, present), len(buckets) - 1)
        at = at[buckets[at] == present]
        return Vectors.sparse(len(buckets), at, ratios[at])

    rows = materialise(
        sample.select(F.when(F.col("label") != 0, 1.0).otherwise(0.0).alias("label"), scaled("text").alias("features")),
        "scaled",
    )
    regression = LogisticRegression(
        maxIter=60, regParam=penalty, standardization=False, featuresCol="features", labelCol="label"
    )
    learnt = regression.fit(rows)
    return Model(buckets, learnt.coefficients.toArray() * ratios, float(learnt.intercept))


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Model:
    """Learns labels of documents outside the held-out fold, of ``fit_docs`` at most."""
    small_batches(docs)
    learn = remainder("doc_id", FOLDS) != HELD_OUT
    return fit(labelled_sample(docs, labels, "toxic", learn, fit_docs))


def score(model: Model) -> Column:
    """Probability that the column ``text`` is toxic."""

    @F.pandas_udf("double")
    @lean
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = model.table()
        known = table != 0
        for texts in batches:
            sums = np.array([total(ngrams(t), table, known) for t in texts], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(sums + model.constant, -500, 500))))

    def total(present: np.ndarray, table: np.ndarray, known: np.ndarray) -> float:
        return table[np.unique(present[known[present]])].sum(dtype=float)

    return scored(text_of())


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    A null text is an empty one; it has no n-gram and gets the constant's score. A null id
    is never labelled. Repeated rows get equal scores. Without both labels every score is
    the share of toxic ones, 0.5 if there are no labels. Other columns are not looked at.
    """
    model = train(docs, labels)
    held_out = remainder("doc_id", FOLDS) == HELD_OUT
    rows = docs.select("doc_id", held_out.alias("held_out"), score(model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected as toxic, with their columns."""
    return docs.where(score(train(docs, labels)) < ACCEPT)

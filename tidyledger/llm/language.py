"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character n-grams. The weights are trained
with follow-the-regularised-leader (per-coordinate rates, L1 and L2 penalties),
which leaves most of them at zero; a temperature fitted on rows that training
left out makes the scores probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.common import arrow_map, checkpointed, slices
from tidyledger.llm.ngrams import (
    code_points,
    document_frequency,
    feature_rows,
    has_letter,
    hashed_ngrams,
    uniform,
)

BUCKETS = 4096
SIZES = range(1, 4)  # n-grams of one to three characters
SAMPLE = 3000  # labelled rows that the classifier is fitted on, at most
L1 = 1.0  # leaves 86 to 94 % of the weights at zero (sf0.1 to sf0.001)
L2 = 0.1
UNDETERMINED = "und"


def counts(array: pa.Array) -> np.ndarray:
    """N-gram counts of the lower-cased texts."""
    array = pc.utf8_lower(array.fill_null(""))
    points, owner = code_points(array)
    return hashed_ngrams(points, owner, len(array), SIZES, BUCKETS)


def tf_idf(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of length one (or zero, if the text has no known n-gram)."""
    weighted = np.log1p(found, dtype=np.float32) * idf
    norm = np.linalg.norm(weighted, axis=1, keepdims=True)
    return weighted / np.where(norm > 0, norm, 1)


@dataclass
class Ftrl:
    """Multinomial FTRL-proximal on dense batches."""

    classes: int
    features: int
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = L1
    l2: float = L2

    def __post_init__(self):
        self.z = np.zeros((self.features, self.classes))
        self.n = np.zeros((self.features, self.classes))

    def weights(self) -> np.ndarray:
        shrunk = np.maximum(np.abs(self.z) - self.l1, 0)
        return -np.sign(self.z) * shrunk / ((self.beta + np.sqrt(self.n)) / self.alpha + self.l2)

    def learn(self, x: np.ndarray, y: np.ndarray) -> None:
        w = self.weights()
        gradient = x.T @ (softmax(x @ w) - np.eye(self.classes)[y])
        squared = self.n + gradient**2
        sigma = (np.sqrt(squared) - np.sqrt(self.n)) / self.alpha
        self.z += gradient - sigma * w
        self.n = squared


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss against smoothed labels.

    Of n rows the label counts (n + 1) / (n + 2) and the other classes share the
    rest (Platt's targets). So the best divisor is finite and above zero even if
    all rows are told apart; it is found by bisecting the slope of the loss, which
    is convex in the inverse of the divisor. Without information in the logits
    (no rows, one class, or worse than chance) it is one or as large as 1,000.
    """
    n, classes = logits.shape
    if not n or classes < 2 or not np.ptp(logits, axis=1).any():
        return 1.0
    targets = np.full((n, classes), 1 / (n + 2) / (classes - 1))
    targets[np.arange(n), y] = (n + 1) / (n + 2)

    def slope(scale: float) -> float:
        return float(((softmax(logits * scale) - targets) * logits).sum())

    low, high = 1e-3, 1.0
    if slope(low) >= 0:
        return 1 / low
    while slope(high) < 0:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if slope(middle) < 0 else (low, middle)
    return 2 / (low + high)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def probabilities(self, array: pa.Array) -> np.ndarray:
        return softmax(tf_idf(counts(array), self.idf) @ self.weights / self.temperature)


def fit(
    df: DataFrame,
    text_column: str = "text",
    language_column: str = "lang",
    id_column: str = "doc_id",
    sample: int = SAMPLE,
    epochs: int = 6,
) -> LanguageModel:
    """Learn from the rows of `df` that have a language.

    Document frequencies cover all of them. The regression is fitted on at most
    `sample` rows, drawn by a hash of the id with about the same number for each
    language; every fifth of these is left out for the temperature. Without
    labelled rows the model knows no language.
    """
    rows = df.filter(F.col(language_column).isNotNull()).select(
        F.col(id_column).cast("string").alias("_id"),
        F.col(language_column).cast("string").alias("_lang"),
        F.col(text_column).alias("_text"),
    )
    # One row per language; ids are drawn before any text is read.
    ids = rows.select("_id", "_lang")
    per_language = checkpointed(ids.groupBy("_lang").agg(F.count("*").alias("_n")))
    each = 0.9 * sample / max(per_language.count(), 1)
    drawn = (
        ids.join(per_language, "_lang")
        .filter(uniform("_id") * F.col("_n") < each)
        .select("_id", F.coalesce(F.md5("_id"), F.lit("")).alias("_order"))
        .orderBy("_order")
        .limit(sample)
    )
    texts = rows.join(F.broadcast(drawn.distinct()), "_id")  # at most `sample` ids
    labels, found = feature_rows(texts, "_text", "_lang", "_order", counts, sample)
    if not labels:
        return LanguageModel([], np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, 0)), 1.0)
    frequency, n = document_frequency(rows, "_text", counts, BUCKETS)
    idf = np.log((1 + n) / (1 + frequency)).astype(np.float32) + 1
    languages = sorted(set(labels))
    y = np.searchsorted(languages, labels)
    x = tf_idf(found, idf).astype(np.float64)
    apart = np.arange(len(y)) % 5 == 4
    if len(set(y[~apart].tolist())) < len(languages):
        apart[:] = False
    model = Ftrl(len(languages), BUCKETS)
    draws = np.random.default_rng(0)
    for _ in range(epochs):
        order = draws.permutation(np.flatnonzero(~apart))
        for at in range(0, len(order), 64):
            part = order[at : at + 64]
            model.learn(x[part], y[part])
    weights = model.weights()
    check = apart if apart.any() else ~apart
    return LanguageModel(languages, idf, weights.astype(np.float32), fit_temperature(x[check] @ weights, y[check]))


def predict(
    df: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The id, `lang_pred` and `score` of every row.

    `und` with score 0 for a text that is null or has no letter, and for every
    text if the model knows no language. Of equal probabilities the language
    first by code point. Repeated rows stay rows; an empty table gives none.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in slices(batches, "_text"):
            text = batch.column("_text")
            best = np.full(len(text), len(model.languages))
            score = np.zeros(len(text))
            some = np.flatnonzero(has_letter(text)) if model.languages else np.zeros(0, int)
            if len(some):
                chances = model.probabilities(text.take(pa.array(some)))
                best[some] = chances.argmax(axis=1)
                score[some] = chances.max(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(names[best], pa.string()), pa.array(score)], ["_id", "lang_pred", "score"]
            )

    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    return arrow_map(rows, compute, f"_id {kind}, lang_pred string, score double").withColumnRenamed("_id", id_column)

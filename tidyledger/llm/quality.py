"""Quality classifier by nearest-neighbour voting.

A text is a latent-semantic vector: TF-IDF weights of its character n-grams and
of the n-grams of its character classes, with some measures of style, reduced by
a singular value decomposition. The vectors of a bounded sample of labelled
texts are broadcast; for every document the exact cosines with all of them are
computed in blocks, and the 25 nearest (all, if there are fewer) vote with a power
of their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.common import Aside, Words, arrow_map, pieces_array, slices
from tidyledger.llm.ngrams import document_frequency, feature_rows, hashed_ngrams, uniform

CONTENT = 512  # buckets of byte n-grams
SHAPE = 1024  # buckets of n-grams of character classes
STYLE = 6
SIZE = CONTENT + SHAPE + STYLE
SAMPLE = 6000  # labelled texts that vote, at most
TOPICS = 64  # dimensions of a vector
NEIGHBOURS = 25  # that vote
SHARPNESS = 8  # power of the similarity that weighs a vote: all texts are rather alike
THRESHOLD = 0.7
_SCALE = 10_000  # measures of style are stored as whole numbers

# Classes of bytes: lower case and UTF-8's high bytes, upper case, digits, other control
# bytes; any other ASCII character is a class of its own.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[128:] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[:9] = 1
_CLASS[14:32] = 1


def _shares(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return _SCALE * part // np.maximum(whole, 1)


def measures(array: pa.Array) -> np.ndarray:
    """Counts of n-grams and measures of style, all whole numbers, a row per text."""
    words = Words(array)
    data, offsets, rows = words.data, words.offsets, len(array)
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(rows), lengths)
    classes = _CLASS[data]
    content = hashed_ngrams(words.lower(), owner, rows, range(3, 4), CONTENT)
    shape = hashed_ngrams(classes, owner, rows, range(2, 5), SHAPE)

    both = np.empty(2 * len(words.starts), np.int64)
    both[0::2], both[1::2] = words.starts, words.ends
    pieces = pieces_array(data, np.append(both, len(data)))
    coded = pieces.take(pa.array(np.arange(len(words.starts)) * 2)).dictionary_encode().indices.to_numpy()
    word_owner = np.repeat(np.arange(rows), words.counts)
    again = np.zeros(len(coded), bool)
    again[1:] = (coded[1:] == coded[:-1]) & (word_owner[1:] == word_owner[:-1])
    distinct = np.bincount(np.unique(word_owner * (len(coded) + 1) + coded) // (len(coded) + 1), minlength=rows)

    def share_of(mask: np.ndarray) -> np.ndarray:
        return _shares(np.bincount(owner[mask], minlength=rows), lengths)

    style = [
        _shares(np.bincount(word_owner[again], minlength=rows), words.counts),
        _SCALE - _shares(distinct, words.counts),
        share_of(classes == ord("A")),
        share_of(classes == ord("0")),
        share_of((classes > 32) & (classes != ord("a")) & (classes != ord("A")) & (classes != ord("0"))),
        share_of(classes == ord("\n")),
    ]
    return np.concatenate([content, shape, np.stack(style, axis=1)], axis=1)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def weighted(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF blocks of length one and the style, side by side."""
    tf = np.log1p(found[:, : CONTENT + SHAPE], dtype=np.float32) * idf[: CONTENT + SHAPE]
    style = np.sqrt(found[:, CONTENT + SHAPE :].astype(np.float32) / _SCALE)
    return np.concatenate([0.5 * _unit(tf[:, :CONTENT]), _unit(tf[:, CONTENT:]), style], axis=1)


@dataclass
class QualityModel:
    """`vectors` and `labels` of the voters; at most SAMPLE rows of TOPICS numbers."""

    idf: np.ndarray
    topics: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def scores(self, array: pa.Array, neighbours: int = NEIGHBOURS) -> np.ndarray:
        result = np.full(len(array), self.prior)
        if not len(self.labels):
            return result
        found = measures(array)
        some = np.flatnonzero(found[:, : CONTENT + SHAPE].any(axis=1))
        k = min(neighbours, len(self.labels))
        for at in range(0, len(some), 256):
            block = some[at : at + 256]
            vectors = _unit(weighted(found[block], self.idf) @ self.topics)
            cosines = vectors @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0) ** SHARPNESS + 1e-9
            result[block] = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(result, 0, 1)


def fit(
    df: DataFrame,
    labelled: DataFrame,
    text_column: str = "text",
    label_column: str = "quality",
    id_column: str = "doc_id",
    sample: int = SAMPLE,
) -> QualityModel:
    """Voters from `labelled` (id and label 0 or 1), joined to the texts in `df` by id.

    Document frequencies cover all rows of `df`. At most `sample` labelled rows
    vote, drawn by a hash of the id; null labels, null ids and labels without a
    text are passed over. Without labels every score is one half.
    """
    usable = labelled.filter(F.col(label_column).isin(0, 1)).select(
        F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("_label")
    )
    total = usable.count()
    drawn = usable.filter(uniform("_id") * max(total, 1) < 0.95 * sample)
    # The order is a hash of the id, so that the limit is as random as the draw.
    drawn = drawn.orderBy(F.md5(F.col("_id").cast("string")), "_label").limit(sample)
    texts = df.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).join(
        F.broadcast(drawn), "_id"  # at most `sample` rows of two numbers
    )
    texts = texts.withColumn("_order", F.md5(F.col("_id").cast("string")))
    labels, found = feature_rows(texts, "_text", "_label", "_order", measures, sample)
    if not labels:
        return QualityModel(np.zeros(SIZE, np.float32), np.zeros((SIZE, 0)), np.zeros((0, 0)), np.zeros(0), 0.5)
    frequency, n = document_frequency(df.select(F.col(text_column).alias("_text")), "_text", measures, SIZE)
    idf = np.log((1 + n) / (1 + frequency)).astype(np.float32) + 1
    rows = weighted(found, idf)
    topics = _leading_directions(rows, TOPICS)
    labels = np.asarray(labels, np.float32)
    return QualityModel(idf, topics, _unit(rows @ topics).astype(np.float32), labels, float(labels.mean()))


def _leading_directions(rows: np.ndarray, topics: int) -> np.ndarray:
    """Right singular vectors by subspace iteration, seeded."""
    start = np.random.default_rng(0).standard_normal((rows.shape[1], min(topics + 16, rows.shape[1])))
    basis = np.linalg.qr(start.astype(np.float32))[0]
    for _ in range(6):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    _, _, right = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ right[:topics].T).astype(np.float32)


def score(
    df: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """All columns of `df` with `score` (0 to 1) and `predicted` (1 from `threshold` on).

    Columns of these names, in any case, are replaced. A null, empty or
    one-character text scores the share of label 1 among the voters. Repeated rows
    stay rows; an empty table gives none. `id_column` is not used in a score.
    """
    aside = Aside(df, ("score", "predicted"))
    text = next(name for name, c in aside.names.items() if c.lower() == text_column.lower())
    rows = df.select(*aside.columns())

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = pa.array(model.scores(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "score"])

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    found = arrow_map(rows, compute, f"{schema}, score double")
    return found.select(*aside.back(), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

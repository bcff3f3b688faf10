"""Hashed character n-gram counts, and what the classifiers gather from Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.common import arrow_map, slices, string_bytes

_MIX = np.uint64(0x9E3779B97F4A7C15)


def code_points(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and the text each belongs to."""
    data, offsets = string_bytes(array)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    first_byte = np.flatnonzero((data & 0xC0) != 0x80)
    owner = np.searchsorted(offsets, first_byte, side="right") - 1
    return points, owner


def hashed_ngrams(symbols: np.ndarray, owner: np.ndarray, rows: int, sizes: range, buckets: int) -> np.ndarray:
    """Counts (rows x buckets) of the n-grams of each text that lie within it."""
    counts = np.zeros(rows * buckets, np.int64)
    value = np.zeros(len(symbols), np.uint64)
    for n in range(1, sizes.stop):
        if len(symbols) < n:
            break
        last = symbols[n - 1 :].astype(np.uint64)
        value = value[: len(last)] * np.uint64(0x100000001B3) + last + np.uint64(1)
        if n < sizes.start:
            continue
        same = owner[n - 1 :] == owner[: len(last)]
        bucket = ((value * _MIX) >> np.uint64(40)).astype(np.int64) % buckets
        counts += np.bincount((owner[: len(last)] * buckets + bucket)[same], minlength=len(counts))
    return counts.reshape(rows, buckets)


Features = Callable[[pa.Array], np.ndarray]


def document_frequency(df: DataFrame, text_column: str, features: Features, size: int) -> tuple[np.ndarray, int]:
    """In how many texts each feature occurs, over all rows, and the number of rows.

    Every task adds up its own rows; the driver gets one row per feature.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(size, np.int64), 0
        for batch in slices(batches, "_text"):
            total += (features(batch.column("_text")) > 0).sum(axis=0)
            rows += batch.num_rows
        if rows:
            some = np.flatnonzero(total)
            place, number = np.append(some, size), np.append(total[some], rows)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(number)], ["place", "n"])

    counted = arrow_map(df.select(F.col(text_column).alias("_text")), compute, "place int, n long")
    found = counted.groupBy("place").agg(F.sum("n").alias("n")).collect()
    frequency, rows = np.zeros(size, np.int64), 0
    for place, n in found:
        if place == size:
            rows = n
        else:
            frequency[place] = n
    return frequency, rows


def feature_rows(df: DataFrame, text_column: str, label: str, order: str, features: Features, limit: int) -> tuple[list, np.ndarray]:
    """Labels and features of at most `limit` rows, those first in `order`."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = np.minimum(features(batch.column("_text")), 65535).astype(np.uint16)
            blobs = pa.array([row.tobytes() for row in found], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_label"), batch.column("_order"), blobs], ["_label", "_order", "_features"]
            )

    kind = df.schema[label].dataType.simpleString()
    named = df.select(
        F.col(label).alias("_label"), F.col(order).alias("_order"), F.col(text_column).alias("_text")
    )
    rows = arrow_map(named, compute, f"_label {kind}, _order string, _features binary")
    found = rows.orderBy("_order", "_label", "_features").limit(limit).collect()
    if not found:
        return [], np.zeros((0, 0))
    return [r[0] for r in found], np.stack([np.frombuffer(r[2], np.uint16) for r in found]).astype(np.float32)


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; of a null id, that of empty text."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % modulus).cast("int")


def uniform(id_column: str) -> Column:
    """A number from 0 to 1 drawn from the id, the same on each run."""
    return F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit(7)), F.lit(1 << 30)) / float(1 << 30)


def has_letter(array: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(array.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)

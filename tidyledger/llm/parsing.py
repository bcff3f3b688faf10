"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases whose borders depend on a few neighbouring symbols
only: deterministic coin tossing gives neighbours different small labels, and a
phrase begins at each local maximum. A phrase is named by a hash of what it
holds, and the names are parsed again, level after level. Equal substrings get
equal names inside, wherever they stand. The names of all levels are sketched by
one-permutation hashing; the share of equal bins is the likeness. A bin prefers
the higher levels, so that long texts are compared by long phrases, and those of
levels 2 and 1 decide where a text has too few of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidyledger.llm.common import arrow_map, checkpointed, slices
from tidyledger.llm.ngrams import code_points

BINS = 64
LEVELS = 6
FIRST_LEVEL = 3  # phrases of some forty characters and more come first in a bin
_TOSSES = 4  # 64 bits, then labels below 128, 14, 8 and 6
_A, _B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x + _C
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    np.multiply.accumulate(np.full(max(n - 1, 0), _A), out=out[1:])
    return out


def _hash_runs(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each run of values; runs begin at `starts`."""
    lengths = np.diff(np.append(starts, len(values)))
    within = np.arange(len(values)) - np.repeat(starts, lengths)
    sums = np.add.reduceat(values * _powers(int(lengths.max()))[within], starts)
    return mix(sums + lengths.astype(np.uint64) * _B)


def _collapse_runs(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal neighbours of a text as one symbol that knows how many they were."""
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(names)))
    kept = names[starts]
    many = lengths > 1
    kept[many] = mix(kept[many] + lengths[many].astype(np.uint64))
    return kept, owner[starts]


def phrases(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level of parsing: the names of the phrases and the text of each."""
    names, owner = _collapse_runs(names, owner)
    n = len(names)
    begins = np.ones(n, bool)
    begins[1:] = owner[1:] != owner[:-1]
    label = names
    for _ in range(_TOSSES):
        before = np.empty_like(label)
        before[1:] = label[:-1]
        # A text's first symbol is compared with its own complement.
        before[begins] = ~label[begins]
        differing = label ^ before
        bit = np.bitwise_count((differing & (~differing + np.uint64(1))) - np.uint64(1)).astype(np.uint64)
        label = np.uint64(2) * bit + ((label >> bit) & np.uint64(1))
    small = label.astype(np.int64)
    left = np.full(n, -1)
    left[1:] = small[:-1]
    left[begins] = 64
    right = np.full(n, 64)
    right[:-1] = small[1:]
    right[:-1][begins[1:]] = 64
    starts = np.flatnonzero(begins | ((small > left) & (small > right)))
    return _hash_runs(names, starts), owner[starts]


def sketch(array: pa.Array) -> np.ndarray:
    """BINS 16-bit numbers per text; 0 marks an empty bin, and an empty text has only those.

    A bin holds the least drawn of the names from FIRST_LEVEL up that fall into it;
    if there is none, of level 2, then of level 1. A text that has become one phrase
    is parsed no further: higher levels would only name the whole text again.
    """
    points, owner = code_points(array)
    names = mix(points.astype(np.uint64))
    nothing = np.iinfo(np.uint64).max
    bins = np.full(len(array) * BINS, nothing, np.uint64)
    waiting = []
    for level in range(1, LEVELS + 1):
        if not len(names):
            break
        names, owner = phrases(names, owner)
        drawn = mix(names + np.uint64(level))
        place = owner * BINS + (drawn >> np.uint64(58)).astype(np.int64)
        if level < FIRST_LEVEL:
            waiting.append((place, drawn))
        else:
            np.minimum.at(bins, place, drawn)
        several = np.bincount(owner, minlength=len(array))[owner] > 1
        names, owner = names[several], owner[several]
    for place, drawn in reversed(waiting):
        open_ = bins[place] == nothing
        np.minimum.at(bins, place[open_], drawn[open_])
    empty = bins == nothing
    found = (mix(bins) % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
    found[empty] = 0
    return found.reshape(len(array), BINS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bins among those that either has; 1 for two empty texts."""
    either = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    return np.where(either > 0, same / np.maximum(either, 1), 1.0)


def _blobs(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows.astype(">u2")], pa.binary())


def edited(text: str, following: str) -> str:
    """The text, its last half replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _compared(ids: pa.Array, texts: list[str], prints: np.ndarray, next_texts: list[str], next_prints: np.ndarray) -> list[pa.Array]:
    changed = [edited(t, f) for t, f in zip(texts, next_texts)]
    changed_prints = sketch(pa.array(changed, pa.string()))
    return [
        ids,
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        _blobs(prints),
        _blobs(changed_prints),
        pa.array(likeness(prints, changed_prints)),
        pa.array(likeness(prints, next_prints)),
    ]


def fingerprint_with_next(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row with its fingerprint, and those of its edited text and of the next row.

    Rows follow each other by descending id, null ids last, rows of the same id by
    a hash of the text; after the last comes the first. Null text is empty. The
    texts are shuffled once, by ranges of the id; only the two texts at the ends
    of each range are looked at again to join the ranges. An only row is its own
    next. An empty table gives no rows.
    """
    kind = df.schema[id_column].dataType.simpleString()
    order = [F.col("_id").desc_nulls_last(), F.xxhash64("_text")]
    ranged = (
        df.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    names = ["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        held = None  # id, text and sketch of the last row, which waits for the next

        def end(row, is_head: bool) -> pa.RecordBatch:
            ids, text, _ = row
            nothing = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays(
                [ids, *nothing, pa.array([place], pa.int32()), pa.array([is_head]), pa.array([text], pa.string())],
                [*names, "_place", "_head", "_end"],
            )

        for batch in slices(batches, "_text"):
            texts = batch.column("_text").to_pylist()
            prints, ids = sketch(batch.column("_text")), batch.column("_id")
            if held is None:
                yield end((ids.slice(0, 1), texts[0], None), True)
            else:
                ids = pa.concat_arrays([held[0], ids])
                texts, prints = [held[1], *texts], np.concatenate([held[2], prints])
            held = (ids.slice(len(ids) - 1), texts[-1], prints[-1:])
            if len(texts) > 1:
                found = _compared(ids.slice(0, len(ids) - 1), texts[:-1], prints[:-1], texts[1:], prints[1:])
                n = len(texts) - 1
                blank = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.string())]
                yield pa.RecordBatch.from_arrays([*found, *blank], [*names, "_place", "_head", "_end"])
        if held is not None:
            yield end(held, False)

    parsed = checkpointed(
        arrow_map(ranged, compute, f"_id {kind}, {_RESULT}, _place int, _head boolean, _end string")
    )
    # Two rows per task: its first and its last text. The window over the places
    # that have rows sees their numbers only; the texts meet by equality of those.
    ends = parsed.filter("_place is not null")
    heads, tails = ends.filter("_head"), ends.filter("not _head")
    by_place = Window.orderBy("_place")
    whole = by_place.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("_place").over(by_place), F.first("_place").over(whole))
    places = heads.select("_place").select("_place", following.alias("_following"))
    tails = (
        tails.select("_id", "_place", "_end")
        .join(places, "_place")
        .join(heads.select(F.col("_place").alias("_following"), F.col("_end").alias("_next")).hint("merge"), "_following")
    )

    def join_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_end"):
            texts, next_texts = batch.column("_end"), batch.column("_next")
            found = _compared(
                batch.column("_id"), texts.to_pylist(), sketch(texts), next_texts.to_pylist(), sketch(next_texts)
            )
            yield pa.RecordBatch.from_arrays(found, names)

    joined = arrow_map(tails.select("_id", "_end", "_next"), join_ends, f"_id {kind}, {_RESULT}")
    rows = parsed.filter("_place is null").select(*names).unionByName(joined)
    return rows.select(
        F.col("_id").alias(id_column),
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )

"""Packing token sequences with the sum-of-squares rule.

Each task packs the documents it reads, one after the other. A level array holds
how many partially filled windows there are of each fill level; a document goes
to the level that makes the sum of the squared counts least, which keeps many
different levels open and so finds exact fits. A document longer than a window
fills whole windows first. What is still open in the end is topped up by cutting
the emptiest windows, and the last one is cut into powers of two, which need no
padding.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.common import arrow_map, slices

CAPACITY = 2048
END_ID = 1
OPEN_LIMIT = 2048  # partially filled windows that a task holds


def _byte_of_character() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary file stand for.

    Visible characters of Latin-1 stand for themselves, the other bytes in order
    for the characters from 256 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of a byte-level BPE, read from its `tokenizers` file.

    The ids of such a file are the order of its merges, which is all that the
    `tiktoken` library needs to give the same ids several times as fast. Tests hold
    the two together for every code point.
    """

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as file:
            model = json.load(file)
        special = {token["content"] for token in model["added_tokens"]}
        byte_of = _byte_of_character()
        ranks = {
            bytes(byte_of[c] for c in piece): i for piece, i in model["model"]["vocab"].items() if piece not in special
        }
        self.encoding = tiktoken.Encoding(
            "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where those of each text begin."""
        found = [np.array(self.encoding.encode_ordinary(text or ""), np.uint32) for text in array.to_pylist()]
        first = np.concatenate([[0], np.cumsum([len(ids) for ids in found], dtype=np.int64)])
        return np.concatenate([np.zeros(0, np.uint32), *found]), first


class Packer:
    """Windows of one task. `put` and `finish` return closed windows.

    A piece is (document, first id, ids); a window is a list of pieces.
    """

    def __init__(self, capacity: int = CAPACITY, open_limit: int = OPEN_LIMIT):
        self.capacity, self.open_limit = capacity, open_limit
        self.levels = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.n_open = 0

    def put(self, document, ids: np.ndarray) -> list[list]:
        closed = []
        at = 0
        while len(ids) - at >= self.capacity:
            closed.append([(document, at, ids[at : at + self.capacity])])
            at += self.capacity
        if at < len(ids):
            piece = (document, at, ids[at:].copy())
            level = self._level(len(ids) - at)
            window = [piece]
            if level:
                window = self._take(level) + window
            self._keep(window, level + len(ids) - at, closed)
        if self.n_open > self.open_limit:
            closed += self._top_up()
        return closed

    def _level(self, size: int) -> int:
        """The fill level (0: a new window) that makes the sum of squares least."""
        levels, last = self.levels, self.capacity - size
        gain = 2 * levels[size:] + 1
        gain[last] = 0  # a full window is no longer counted
        cost = gain - (2 * levels[: last + 1] - 1)
        cost[levels[: last + 1] == 0] = np.iinfo(np.int64).max
        cost[0] = gain[0]
        # Of equal levels the fullest.
        return last - int(np.argmin(cost[::-1]))

    def _take(self, level: int) -> list:
        self.levels[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def _keep(self, window: list, level: int, closed: list[list]) -> None:
        if level == self.capacity:
            closed.append(window)
        else:
            self.levels[level] += 1
            self.n_open += 1
            self.open.setdefault(level, []).append(window)

    def _top_up(self) -> list[list]:
        """Fill the fullest open windows with pieces cut from the emptiest; one stays open."""
        windows = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        self.open, self.n_open = {}, 0
        self.levels[:] = 0
        closed: list[list] = []
        first, last = 0, len(windows) - 1
        room = self.capacity - sum(len(p[2]) for p in windows[0]) if windows else 0
        while first < last:
            document, start, ids = windows[last].pop()
            if len(ids) > room:
                windows[last].append((document, start, ids[: len(ids) - room]))
                start, ids = start + len(ids) - room, ids[len(ids) - room :]
            windows[first].append((document, start, ids))
            room -= len(ids)
            if not windows[last]:
                last -= 1
            if not room:
                closed.append(windows[first])
                first += 1
                room = self.capacity - sum(len(p[2]) for p in windows[first]) if first <= last else 0
        if first == last and windows[first]:
            self._keep(windows[first], sum(len(p[2]) for p in windows[first]), closed)
        return closed

    def finish(self) -> list[list]:
        closed = self._top_up()
        for windows in self.open.values():
            for window in windows:
                left = sum(len(p[2]) for p in window)
                while left:
                    room = 1 << (left.bit_length() - 1)
                    left -= room
                    part = []
                    while room:
                        document, start, ids = window.pop(0)
                        part.append((document, start, ids[:room]))
                        if len(ids) > room:
                            window.insert(0, (document, start + room, ids[room:]))
                        room -= min(room, len(ids))
                    closed.append(part)
        return closed


def pack(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: the id, `start`, `length`, `ids_crc32`, `doc_tokens`,
    `sequence_id` and `offset`.

    A document is its ids and `end_id`; null text is empty, so every row has at
    least one piece. Rows with the same id are documents of their own. Sequences
    lie gapless from offset 0 and are full or a power of two long. An empty table
    gives no rows.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    kind = df.schema[id_column].dataType.simpleString()
    schema = (
        f"_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = None, Packer(capacity)
        sequence = TaskContext.get().partitionId() << 33
        id_type = None

        def rows(closed: list[list]) -> pa.RecordBatch:
            nonlocal sequence
            columns: list[list] = [[] for _ in range(7)]
            for window in closed:
                offset = 0
                for (doc, tokens), start, ids in window:
                    crc = zlib.crc32(ids.tobytes())
                    for column, value in zip(columns, (doc, start, len(ids), crc, tokens, sequence, offset)):
                        column.append(value)
                    offset += len(ids)
                sequence += 1
            arrays = [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])]
            names = ["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in slices(batches, "_text"):
            encoder = encoder or Encoder(path)
            id_type = batch.schema.field("_id").type
            flat, first = encoder.encode(batch.column("_text"))
            flat = np.insert(flat, first[1:], np.uint32(end_id)).astype("<u4")
            first = first + np.arange(len(first))
            closed = []
            for i, doc in enumerate(batch.column("_id").to_pylist()):
                ids = flat[first[i] : first[i + 1]]
                closed += packer.put((doc, len(ids)), ids)
            if closed:
                yield rows(closed)
        if id_type is not None:
            yield rows(packer.finish())

    rows = df.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    return arrow_map(rows, compute, schema).withColumnRenamed("_id", id_column)

"""What several operators of this package share: checkpoints, batches, words."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of characters other than space, tab, newline, vertical tab,
# form feed and carriage return. The same set for Spark's and for byte code.
WORD = r"[^\x20\x09-\x0D]+"
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

# Text that a worker looks at in one step; a longer text is a step of its own.
STEP_BYTES = 1 << 20
STEP_ROWS = 1024
# Rows that Spark hands to a worker at once, if the session has Spark's default of
# ten times as many: texts may be long, and a batch is held in memory whole.
BATCH_ROWS = 1000

# White space beyond ASCII in UTF-8, by Unicode's White_Space property (fixed values).
_WIDE_SPACES = [
    c.encode() for c in map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
]


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the folder that all executors share, with a short lineage.

    The folder is the session's `spark.checkpoint.dir`. Where that is unset, a
    local session (as in tests) gets a temporary one; on a cluster it is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is not set; name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint()


def arrow_map(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """`df.mapInArrow`, with batches small enough for long texts.

    A size of batches that the session sets itself is left alone.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(setting) == "10000":
        df.sparkSession.conf.set(setting, str(BATCH_ROWS))
    return df.mapInArrow(function, schema)


def text_of(name: str = "text") -> Column:
    """The column with null as empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def quoted(name: str) -> str:
    """A column name that may hold dots or any other character."""
    return "`" + name.replace("`", "``") + "`"


class Aside:
    """The columns of a table under names that no operator gives, and back.

    Columns named like one of `replaced`, in any case, are left out: the operator
    has new ones of these names.
    """

    def __init__(self, df: DataFrame, replaced: Sequence[str] = ()):
        gone = {name.lower() for name in replaced}
        self.names = {f"_in{i}": c for i, c in enumerate(df.columns) if c.lower() not in gone}

    def columns(self) -> list[Column]:
        """Of the table, under the other names."""
        return [F.col(quoted(c)).alias(name) for name, c in self.names.items()]

    def back(self) -> list[Column]:
        """Of a table with the other names, under their own."""
        return [F.col(name).alias(c) for name, c in self.names.items()]


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(
    batches: Iterator[pa.RecordBatch], column: str, step_bytes: int = STEP_BYTES, step_rows: int = STEP_ROWS
) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most `step_rows` rows with `step_bytes` of `column`, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = string_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + step_bytes, side="right")) - 1
            stop = min(max(stop, start + 1), start + step_rows, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def string_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values one after the other, and where each begins; null is empty."""
    if array.null_count:
        array = array.fill_null("")
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    _, offsets, data = array.buffers()
    if not len(array) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


class Words:
    """The words of a batch of texts as positions in its bytes.

    `starts` and `ends` point into `data`; words `first[i]` to `first[i + 1] - 1`
    belong to text i. `outside` marks the bytes between words.
    """

    def __init__(self, array: pa.Array, outside: np.ndarray = _SPACE):
        self.data, self.offsets = string_bytes(array)
        inside = ~outside[self.data]
        begins, finishes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        finishes[:-1] &= ~inside[1:]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < len(self.data))]
        begins[cuts] = inside[cuts]
        finishes[cuts - 1] = inside[cuts - 1]
        self.inside = inside
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def lower(self) -> np.ndarray:
        """The bytes with A-Z as a-z."""
        return _LOWER[self.data]


def pieces_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Byte strings `data[offsets[i]:offsets[i + 1]]` as an Arrow array, without a copy."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


def _white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to a white-space character of Unicode."""
    space = _SPACE[data]
    leads = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    for code in _WIDE_SPACES:
        at = leads[leads + len(code) <= len(data)]
        for step, byte in enumerate(code):
            at = at[data[at + step] == byte]
        for step in range(len(code)):
            space[at + step] = True
    return space


def pieces_between_spaces(array: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The texts cut before each single space that stands between two visible characters.

    Tokenizers that begin a token at such a space give the same ids for the
    pieces as for the text. The second result has the first piece of each text
    (an empty text has none).
    """
    data, offsets = string_bytes(array)
    space = _white_space(data)
    cut = np.zeros(len(data), dtype=bool)
    if len(data) > 2:
        cut[1:-1] = (data[1:-1] == 0x20) & ~space[:-2] & ~space[2:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    # The last byte of a text has no character after it in the same text.
    cut[inner - 1] = False
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(cut)
    return pieces_array(data, np.append(starts, len(data))), np.searchsorted(starts, offsets)

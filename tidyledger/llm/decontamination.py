"""Benchmark decontamination: Wu-Manber search for many test strings at once.

The test strings are the windows of the benchmark items, as numbers of words; a
word that no item has is no number at all. Those of one length share tables. A
shift table says for a block of words how far a search may go on, since no test
string can have the block nearer to its end. Where it says zero, the suffix hash
picks the test strings that may end there, and a word by word comparison
confirms them. All texts of a step are searched at once, cut into lanes whose
cursors each jump by their own shift.

Items are compiled in blocks of bounded size, on executors, into files of the
shared folder; a task goes through all files for each step of its texts, with
one in memory at a time. The texts are neither shuffled nor copied.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.common import Words, arrow_map, pieces_array, slices
from tidyledger.llm.shared import Blocks, new_folder, store_arrays

WINDOW = 10  # words of a test string; an item of fewer is one test string
BLOCK_WORDS = 3  # words by which the shift table is addressed
BLOCK_BYTES = 8 << 20  # text of the items whose tables are in memory together
LANE = 256  # ends of windows that one cursor looks at
STEP = 4 << 20  # bytes of text searched at once
_MIX = np.uint64(0x9E3779B97F4A7C15)

# Words are runs of 0-9, A-Z, a-z and all characters beyond ASCII.
_OUTSIDE = np.ones(256, bool)
_OUTSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _words(array: pa.Array) -> tuple[Words, pa.Array]:
    """The words of the texts and their lower-cased bytes."""
    words = Words(array, _OUTSIDE)
    both = np.empty(2 * len(words.starts), np.int64)
    both[0::2], both[1::2] = words.starts, words.ends
    lower = words.lower()
    pieces = pieces_array(lower, np.append(both, len(lower)))
    return words, pieces.take(pa.array(np.arange(len(words.starts)) * 2))


def _hash(numbers: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """A hash of the `length` words that end at each of `ends`."""
    value = np.zeros(len(ends), np.uint64)
    for back in range(length):
        value = (value ^ numbers[ends - back].astype(np.uint64)) * _MIX
        value ^= value >> np.uint64(29)
    return value


def compiled(item_ids: list[str | None], texts: pa.Array, window: int = WINDOW) -> dict[str, np.ndarray]:
    """The tables of some items as plain arrays, those of length m under names that end in m.

    `shift`: places to go on, by block hash. `hash`, sorted: suffix hash of each
    test string, over all of its words. `at`: where its words begin in `numbers`.
    `first`, `items`: the items that have it. An item without an id has no number.
    """
    words, pieces = _words(texts)
    coded = pieces.dictionary_encode()
    numbers = coded.indices.to_numpy().astype(np.int32)
    vocabulary = coded.dictionary.to_pylist()
    names = sorted({i for i in item_ids if i is not None})
    place = {name: k for k, name in enumerate(names)}
    owner = np.array([place.get(i, -1) for i in item_ids], np.int32)
    tables = {
        "numbers": numbers,
        "vocabulary": np.frombuffer(b"".join(vocabulary), np.uint8),
        "lengths": np.array([len(w) for w in vocabulary], np.int64),
        "names": np.frombuffer("".join(names).encode(), np.uint8),
        "name_lengths": np.array([len(n.encode()) for n in names], np.int64),
    }
    longest = np.minimum(words.counts, window)
    bits = max(12, math.ceil(math.log2(8 * len(numbers) + 1)))
    for m in np.unique(longest[longest > 0]).tolist():
        some = np.flatnonzero(longest == m)
        number = words.counts[some] - m + 1
        skip = np.repeat(np.cumsum(number) - number, number)
        at = np.repeat(words.first[some], number) + np.arange(number.sum()) - skip
        item = np.repeat(owner[some], number)
        block = min(BLOCK_WORDS, m)
        shift = np.full(1 << bits, m - block + 1, np.uint8 if m < 256 else np.int32)
        for end in range(block - 1, m):  # nearer to the end is later and smaller
            shift[_hash(numbers, at + end, block) >> np.uint64(64 - bits)] = m - 1 - end
        value = _hash(numbers, at + m - 1, m)
        order = np.argsort(value, kind="stable")
        at, item, value = at[order], item[order], value[order]
        new = np.append(True, value[1:] != value[:-1])
        for k in range(m):
            column = numbers[at + k]
            new[1:] |= column[1:] != column[:-1]
        string = np.cumsum(new) - 1
        pairs = np.unique(np.stack([string, item])[:, item >= 0], axis=1)
        tables |= {
            f"shift{m}": shift,
            f"hash{m}": value[new],
            f"at{m}": at[new],
            f"first{m}": np.searchsorted(pairs[0], np.arange(new.sum() + 1)),
            f"items{m}": pairs[1].astype(np.int32),
        }
    return tables


class Search:
    """The test strings of one file of tables."""

    def __init__(self, tables: dict[str, np.ndarray]):
        self.tables = tables
        self.vocabulary = pieces_array(tables["vocabulary"], np.append(0, np.cumsum(tables["lengths"])))
        names = tables["names"].tobytes()
        ends = np.cumsum(tables["name_lengths"])
        self.names = [names[e - n : e].decode() for e, n in zip(ends.tolist(), tables["name_lengths"].tolist())]
        self.lengths = sorted(int(k.removeprefix("shift")) for k in tables if k.startswith("shift"))

    def occurrences(self, numbers: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Where test strings of `m` words begin in `numbers`, and which; -1 is no word of theirs."""
        t = self.tables
        block, shift = min(BLOCK_WORDS, m), t[f"shift{m}"]
        down = np.uint64(64 - (len(shift).bit_length() - 1))
        now = np.arange(m - 1, len(numbers), LANE)
        stop = np.minimum(now + LANE, len(numbers))
        found = []
        while len(now):
            jump = shift[_hash(numbers, now, block) >> down].astype(np.int64)
            jump[numbers[now] < 0] = m  # no test string reaches over this word
            found.append(now[jump == 0])
            now = now + np.maximum(jump, 1)
            going = now < stop
            now, stop = now[going], stop[going]
        ends = np.concatenate(found) if found else np.zeros(0, np.int64)
        value = _hash(numbers, ends, m)
        low = np.searchsorted(t[f"hash{m}"], value, "left")
        number = np.searchsorted(t[f"hash{m}"], value, "right") - low
        begin, string = [], []
        for k in range(int(number.max(initial=0))):
            here = np.flatnonzero(number > k)
            candidate, start = low[here] + k, ends[here] - m + 1
            same = np.ones(len(here), bool)
            for j in range(m):
                same &= numbers[start + j] == t["numbers"][t[f"at{m}"][candidate] + j]
            begin.append(start[same])
            string.append(candidate[same])
        if not begin:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(begin), np.concatenate(string)

    def mark(self, pieces: pa.Array, is_word: np.ndarray, begin: np.ndarray, change: np.ndarray, items: dict) -> None:
        """Add what the tables find: to `change` +1 where an occurrence begins and -1 behind it,
        to `items` the items that have it, by text."""
        numbers = np.full(len(is_word), -1, np.int32)
        codes = pc.index_in(pieces, value_set=self.vocabulary)
        numbers[is_word] = codes.fill_null(-1).to_numpy()
        for m in self.lengths:
            start, string = self.occurrences(numbers, m)
            np.add.at(change, start, 1)
            np.add.at(change, start + m, -1)
            text = np.searchsorted(begin, start, "right") - 1
            first, listed = self.tables[f"first{m}"], self.tables[f"items{m}"]
            pairs = np.unique(np.stack([text, string]), axis=1)
            for of, a, b in zip(pairs[0].tolist(), first[pairs[1]].tolist(), first[pairs[1] + 1].tolist()):
                items.setdefault(of, set()).update(self.names[i] for i in listed[a:b].tolist())


def _compile(items: DataFrame, folder: str, window: int) -> list[str]:
    """Names of the files of tables, each of items of at most about BLOCK_BYTES or of one item."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flushed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            texts = pa.concat_arrays([c.cast(pa.large_string()) for c in table["_text"].chunks])
            name = store_arrays(folder, compiled(table["_item"].to_pylist(), texts, window))
            return pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

        for batch in slices(batches, "_text", BLOCK_BYTES, 1 << 30):
            if held and size + batch.nbytes > BLOCK_BYTES:
                yield flushed()
                held, size = [], 0
            held.append(batch)
            size += batch.nbytes
        if held:
            yield flushed()

    size = items.select(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    dealt = items.repartition(max(1, math.ceil(size / BLOCK_BYTES)))
    return [r[0] for r in arrow_map(dealt, write, "name string").collect()]


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The id, `n_words`, `n_hit`, `spans` and `items` of every row of `df`.

    Words are lower-cased runs of letters and digits of ASCII and of all other
    characters beyond it. A test string is `window` words of an item in a row, or
    a shorter item whole. `n_hit` words lie inside an occurrence of one; `spans`
    are the runs of such words, as word positions from 0 (`end` exclusive).
    `items` are the ids, as text and sorted as text, of the items that have a
    test string there, each once however many rows of `benchmark` have the id; an
    item with a null id marks words and is not listed. Null and empty texts have
    no words; items without words are never found. Repeated rows stay rows; an
    empty table gives none. Other columns are not read.
    """
    folder = new_folder(df.sparkSession, "wu-manber")
    items = benchmark.select(F.col(item_column).cast("string").alias("_item"), F.col(item_text_column).alias("_text"))
    names = _compile(items.filter("_text is not null"), folder, window)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(folder, names)
        for batch in slices(batches, "_text", STEP, 1 << 16):
            words, pieces = _words(batch.column("_text"))
            # Between two texts stands a place that is no word.
            begin = words.first + np.arange(len(words.first))
            is_word = np.ones(begin[-1], bool)
            is_word[begin[1:] - 1] = False
            change = np.zeros(len(is_word) + 1, np.int32)
            found: dict[int, set[str]] = {}
            for tables in blocks.each(Search):
                tables.mark(pieces, is_word, begin, change, found)
            hit = np.cumsum(change)[:-1] > 0
            total = np.concatenate([[0], np.cumsum(hit)])
            edge = np.flatnonzero(np.diff(hit, prepend=False))  # begin, end, begin, ...
            first = np.searchsorted(edge[0::2], begin).astype(np.int32)
            base = np.repeat(begin[:-1], np.diff(first))
            spans = pa.StructArray.from_arrays([pa.array(edge[0::2] - base), pa.array(edge[1::2] - base)], ["start", "end"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(words.counts),
                    pa.array(total[begin[1:]] - total[begin[:-1]]),
                    pa.ListArray.from_arrays(pa.array(first), spans),
                    pa.array([sorted(found.get(i, ())) for i in range(batch.num_rows)], pa.list_(pa.string())),
                ],
                ["_id", "n_words", "n_hit", "spans", "items"],
            )

    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    schema = f"_id {kind}, n_words long, n_hit long, spans array<struct<start:long,end:long>>, items array<string>"
    return arrow_map(rows, search, schema).withColumnRenamed("_id", id_column)

"""Interpolated modified Kneser-Ney language model of word n-grams.

Counting: each task merges the n-grams of its texts and sends them, packed, to
buckets by their context, the words before the last; a context whose words would
each fill a good part of a bucket is spread over all buckets by the n-gram. A
bucket sums its n-grams and stores them as an array of sorted hashes with counts.
Each distinct one counts once for the n-gram without its first word, which is
counted in the same way, down to pairs; what the buckets of pairs know of each
word (followers, predecessors) is summed in buckets of words, and what longer
n-grams say of their contexts in buckets of contexts. Scoring: a task looks up the
distinct words and n-grams of a step of texts at once. It memory-maps the arrays
of the buckets that they fall in, and holds a bounded number of maps.
"""

from __future__ import annotations

import math
import tempfile
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.common import Words, arrow_map, checkpointed, pieces_array, slices
from tidyledger.llm.ngrams import uniform
from tidyledger.llm.shared import new_folder, store

END = np.uint64(1)
START = np.uint64(2)
ORDER = 2  # words of an n-gram
STEP = 6 << 20  # bytes of text whose n-grams are merged at once
BUCKET_CHARS = 8_000_000  # characters of the corpus for each bucket
_FILLS = 0.25  # of a bucket: a word with so many of the tokens is spread over all buckets
MOST_FREQUENT = 1 << 20  # words that are spread at most; no other has a greater share than 1 in so many
_LOOKED_AT = 400  # texts, and one more for each bucket, in which the frequent words are looked for
MAPS = 4096  # arrays that a task holds mapped at once
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

# Of a context: what follows it in all, and how many words do so 1, 2, 3 or more times.
CONTEXT = np.dtype([(name, "<i8") for name in ("total", "once", "twice", "more")])
# Of a word also how often it occurs, and after how many different words.
WORD = np.dtype([("count", "<i8"), *CONTEXT.descr, ("before", "<i8")])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def gram_key(words: list[np.ndarray]) -> np.ndarray:
    """A hash of each n-gram; `words` are the hashes of its words, first to last."""
    key = _mix(words[0] + _A)
    for word in words[1:]:
        key = _mix(key + word * _A)
    return key


def tokens(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words of the texts, the token numbers of all texts in a
    row with a start (0) before and an end (1) after each text, where each text
    begins, and which numbers are the first of a pair.

    Number n stands for `hashes[n]`.
    """
    words = Words(array)
    both = np.empty(2 * len(words.starts), np.int64)
    both[0::2], both[1::2] = words.starts, words.ends
    lower = words.lower()
    pieces = pieces_array(lower, np.append(both, len(lower)))
    coded = pieces.take(pa.array(np.arange(len(words.starts)) * 2)).dictionary_encode()
    hash_of = xxhash.xxh64_intdigest
    distinct = np.fromiter((hash_of(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    hashes = np.concatenate([[START, END], distinct]).astype(np.uint64)
    begin = words.first + 2 * np.arange(len(words.first))
    numbers = np.empty(begin[-1], np.int64)
    is_word = np.ones(begin[-1], bool)
    is_word[begin[:-1]] = False
    is_word[begin[1:] - 1] = False
    numbers[is_word] = coded.indices.to_numpy().astype(np.int64) + 2
    numbers[begin[:-1]] = 0
    numbers[begin[1:] - 1] = 1
    has_next = np.ones(begin[-1], bool)
    has_next[begin[1:] - 1] = False
    return hashes, numbers, begin, has_next


def grams(numbers: np.ndarray, begin: np.ndarray, has_next: np.ndarray, order: int) -> list[np.ndarray]:
    """The `order` numbers that end at each token; before a text stand as many starts as are needed."""
    last = np.flatnonzero(has_next) + 1
    floor = np.repeat(begin[:-1], np.diff(begin) - 1)
    return [numbers[np.maximum(last - back, floor)] for back in range(order - 1, -1, -1)]


def _codes(columns: list[np.ndarray], size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """One number for each row of numbers below `size`, and what its front part stands for, column by column."""
    code, fronts = columns[0], []
    for column in columns[1:]:
        if len(fronts) < len(columns) - 2:
            front, code = np.unique(code * size + column, return_inverse=True)
            fronts.append(front)
        else:
            code = code * size + column
    return code, fronts


def _counted(columns: list[np.ndarray], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows, column by column and sorted, and how often each occurs."""
    code, fronts = _codes(columns, size)
    front, times = np.unique(code, return_counts=True)
    found = [front % size]
    front = front // size
    for known in reversed(fronts):
        front = known[front]
        found.append(front % size)
        front = front // size
    return [front, *found[::-1]], times


def _distinct(columns: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct row, and which of them each row is."""
    found, which = np.unique(_codes(columns, size)[0], return_inverse=True)
    at = np.empty(len(found), np.int64)
    at[which] = np.arange(len(which))
    return at, which


def _bucket(words: list[np.ndarray], frequent: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each n-gram: by its context, or by all of it if all words of the context are frequent."""
    spread = np.isin(words[0], frequent)
    for word in words[1:-1]:
        spread &= np.isin(word, frequent)
    return (np.where(spread, gram_key(words), gram_key(words[:-1])) % np.uint64(buckets)).astype(np.int64)


def _part_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a word or context: by range of its hash."""
    return (key >> np.uint64(32)).astype(np.int64) * buckets >> 32


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sums of the values for each distinct combination of keys, in order of the keys."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    return [k[at] for k in keys], [np.add.reduceat(v[order], at) if len(at) else v for v in values]


def _packed(bucket: np.ndarray, arrays: list[np.ndarray]) -> pa.RecordBatch:
    """A row for each bucket with its part of every array, compressed."""
    order = np.argsort(bucket, kind="stable")
    at = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    cuts = np.append(at, len(order))
    columns = [pa.array(bucket[order][at].astype(np.int32)), pa.array(np.diff(cuts))]
    for array in arrays:
        array = array[order]
        blobs = [pa.compress(array[a:b].tobytes(), "zstd", asbytes=True) for a, b in zip(cuts, cuts[1:])]
        columns.append(pa.array(blobs, pa.binary()))
    return pa.RecordBatch.from_arrays(columns, ["bucket", "n", *[f"a{i}" for i in range(len(arrays))]])


def _by_bucket(batches: Iterator[pa.RecordBatch], kinds: list) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The arrays of one bucket after the other; rows come sorted by bucket."""
    now, parts = None, []

    def joined():
        return now, [np.concatenate([p[i] for p in parts]) for i in range(len(kinds))]

    for batch in batches:
        numbers, columns = batch.column(1).to_pylist(), [batch.column(i + 2) for i in range(len(kinds))]
        for row, bucket in enumerate(batch.column(0).to_pylist()):
            if bucket != now and parts:
                yield joined()
                parts = []
            now = bucket
            parts.append([_unpacked(c[row].as_buffer(), numbers[row], k) for c, k in zip(columns, kinds)])
    if parts:
        yield joined()


def _unpacked(blob: pa.Buffer, number: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, number * np.dtype(kind).itemsize, "zstd"), kind)


def _store(folder: str, name: str, array: np.ndarray) -> None:
    store(folder, name, memoryview(np.ascontiguousarray(array)).cast("B") if len(array) else b"")


def narrow(counts: np.ndarray) -> np.ndarray:
    """The counts in the smallest kind of whole number that holds them all."""
    most = int(counts.max(initial=0))
    return counts.astype(next(kind for kind in ("<u1", "<u2", "<u4", "<u8") if most <= np.iinfo(kind).max))


def _mapped(folder: str, name: str) -> np.ndarray:
    """The bytes of a stored array, memory-mapped; a copy on this machine if the folder is not a local path."""
    filesystem, path = fs.FileSystem.from_uri(folder)
    path = f"{path}/{name}"
    info = filesystem.get_file_info(path)
    if info.type == fs.FileType.NotFound or not info.size:
        return np.zeros(0, np.uint8)
    if isinstance(filesystem, fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r")
    with tempfile.TemporaryFile() as copy, filesystem.open_input_stream(path) as source:
        while part := source.read(8 << 20):
            copy.write(part)
        copy.flush()
        return np.memmap(copy, np.uint8, "r")


def discounts(n: list[int]) -> list[float]:
    """Discounts for counts of 1, 2 and 3 or more from the numbers of counts 1 to 4.

    Where a number is missing (small corpora) the discount is half the count, at
    most one; a discount is never below 0 or above its count.
    """
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    found = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] and n[k] and y else min(k / 2, 1.0)
        found.append(min(max(d, 0.05), float(k)))
    return found


@dataclass
class Model:
    """Where the arrays are and the totals of the corpus; small enough to travel with a job."""

    folder: str
    order: int
    buckets: int
    frequent: np.ndarray
    train_tokens: int
    types: int
    pairs: int
    gram_discounts: dict[int, list[float]]  # by the number of words
    word_discounts: list[float]
    word_counts: list[int]  # words with 1, 2 and 3 or more predecessors

    def remove(self) -> None:
        """Delete the stored arrays; nothing can be scored with the model afterwards."""
        filesystem, path = fs.FileSystem.from_uri(self.folder)
        filesystem.delete_dir(path)


def _context_sums(context: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct contexts of n-grams that stand by context, and the fields of CONTEXT."""
    at = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    fields = [np.add.reduceat(x.astype(np.int64), at) for x in (times, times == 1, times == 2, times >= 3)]
    return context[at], fields


def _schema(arrays: int) -> str:
    return "bucket int, n long, " + ", ".join(f"a{i} binary" for i in range(arrays))


def _padded(batch: pa.RecordBatch, arrays: int, kind: int, totals: list[int] | None) -> pa.RecordBatch:
    """The batch with nulls for the arrays it lacks, its kind, and totals in its first row."""
    rows = batch.num_rows
    for i in range(batch.num_columns - 2, arrays):
        batch = batch.append_column(f"a{i}", pa.nulls(rows, pa.binary()))
    batch = batch.append_column("kind", pa.array(np.full(rows, kind, np.int32)))
    return batch.append_column("totals", pa.array([totals, *[None] * (rows - 1)], pa.list_(pa.int64())))


def train(df: DataFrame, text_column: str = "text", id_column: str = "doc_id", order: int = ORDER) -> Model:
    """Count the n-grams of `order` words (2 at least) of all texts of `df` and store the model.

    The model grows with the distinct n-grams of the corpus and lies in the folder
    that the cluster shares until `Model.remove`. Null text is empty: it trains the
    end after the start. A table without rows gives a model that knows no word.
    """
    folder = new_folder(df.sparkSession, "kneser-ney")
    rows = df.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    size, number = rows.select(F.coalesce(F.sum(F.length("_text")), F.lit(0)), F.count("*")).first()
    buckets = max(8, math.ceil(size / BUCKET_CHARS))
    frequent = _frequent_words(rows, number, buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", STEP, 1 << 16):
            hashes, numbers, begin, has_next = tokens(batch.column("_text"))
            found, times = _counted(grams(numbers, begin, has_next, order), len(hashes))
            words = [hashes[column] for column in found]
            # Equal contexts stand together and compress well.
            yield _packed(_bucket(words, frequent, buckets), [*words, times.astype(np.uint32)])

    def merged(level: int):
        """Sums and stores the n-grams of `level` words; gives those of a word less, and the contexts.

        On the way to pairs the number of all occurrences travels with the n-grams.
        Pairs give words, with all that is known of them.
        """
        top = level == order
        kinds = [np.uint64] * level + ([np.uint32] if top else [np.int64, np.int64])

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, found in _by_bucket(batches, kinds):
                words, values = _summed(found[:level], [v.astype(np.int64) for v in found[level:]])
                times, occurrences = values[0], values[-1]
                key = gram_key(words)
                by_key = np.argsort(key)
                _store(folder, f"keys{level}-{bucket}", key[by_key])
                _store(folder, f"counts{level}-{bucket}", narrow(times[by_key]))
                totals = [int((times == k).sum()) for k in (1, 2, 3, 4)]
                if level > 2:
                    context, fields = _context_sums(gram_key(words[:-1]), times)
                    yield _padded(_packed(_part_of(context, buckets), [context, *fields]), width, 1, totals)
                    (*rest,), (each, occurrences) = _summed(words[1:], [np.ones(len(times), np.int64), occurrences])
                    packed = _packed(_bucket(rest, frequent, buckets), [*rest, each, occurrences])
                    yield _padded(packed, width, 0, None)
                    continue
                first, fields = _context_sums(words[0], times)
                if not top:
                    fields.insert(0, _context_sums(words[0], occurrences)[1][0])
                preceded, by = np.unique(words[1], return_counts=True)
                zeros, more = np.zeros(len(preceded), np.int64), np.zeros(len(first), np.int64)
                fields = [*[np.concatenate([f, zeros]) for f in fields], np.concatenate([more, by])]
                (word,), fields = _summed([np.concatenate([first, preceded])], fields)
                yield _padded(_packed(_part_of(word, buckets), [word, *fields]), width, 1, totals)

        width = max(level + 1, len(CONTEXT.names) + 1) if level > 2 else len(WORD.names) + (not top)
        return merge, width

    def contexts(level: int):
        def store_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, (context, *fields) in _by_bucket(batches, [np.uint64] + [np.int64] * len(CONTEXT.names)):
                (context,), fields = _summed([context], fields)
                stored = np.empty(len(context), CONTEXT)
                for name, values in zip(CONTEXT.names, fields):
                    stored[name] = values
                _store(folder, f"contexts{level}-{bucket}", context)
                _store(folder, f"sums{level}-{bucket}", stored)
                yield pa.RecordBatch.from_arrays([pa.array([[len(context)]], pa.list_(pa.int64()))], ["totals"])

        return store_sums

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # In a model of pairs what follows a word in all is how often it occurs.
        names = WORD.names if order > 2 else ("total", *WORD.names[2:])
        for bucket, (word, *fields) in _by_bucket(batches, [np.uint64] + [np.int64] * len(names)):
            (word,), fields = _summed([word], fields)
            stored = np.empty(len(word), WORD)
            for name, values in zip(names, fields):
                stored[name] = values
            if order == 2:
                stored["count"] = stored["total"]
            # The end is never followed; it occurs once after each text.
            stored["count"][word == END] = number
            _store(folder, f"hashes-{bucket}", word)
            _store(folder, f"words-{bucket}", stored)
            real = stored[word != START]
            before = real["before"]
            total = [int(real["count"].sum()), len(real), int(before.sum(dtype=np.int64)), int((before >= 3).sum())]
            total += [int((before == k).sum()) for k in (1, 2, 3, 4)]
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], ["totals"])

    def by_bucket(df: DataFrame, arrays: int) -> DataFrame:
        columns = ["bucket", "n", *[f"a{i}" for i in range(arrays)]]
        return df.select(*columns).repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket")

    parts = by_bucket(arrow_map(rows, count, _schema(order + 1)), order + 1)
    gram_discounts = {}
    for level in range(order, 1, -1):
        merge, width = merged(level)
        made = checkpointed(arrow_map(parts, merge, f"{_schema(width)}, kind int, totals array<bigint>"))
        gram_discounts[level] = discounts(_sum_arrays(made.filter("totals is not null"), 4))
        if level > 2:
            sums = by_bucket(made.filter("kind = 1"), len(CONTEXT.names) + 1)
            _sum_arrays(arrow_map(sums, contexts(level), "totals array<bigint>"), 1)
            parts = by_bucket(made.filter("kind = 0"), level + 1)
        else:
            parts = by_bucket(made, width)
    total = _sum_arrays(checkpointed(arrow_map(parts, words, "totals array<bigint>")), 8)
    return Model(
        folder, order, buckets, frequent, total[0], total[1], total[2],
        gram_discounts, discounts(total[4:]), [total[4], total[5], total[3]],
    )


def _sum_arrays(df: DataFrame, n: int) -> list[int]:
    found = df.select(*[F.coalesce(F.sum(F.element_at("totals", i + 1)), F.lit(0)).alias(f"t{i}") for i in range(n)])
    return list(found.first())


def _frequent_words(rows: DataFrame, number: int, buckets: int) -> np.ndarray:
    """Words that a glance at some texts finds to fill a part of a bucket, at most MOST_FREQUENT.

    They decide where pairs are counted, not what is counted. The limit follows
    the size of a bucket, so that no bucket grows with the corpus.
    """
    limit = max(_FILLS / buckets, 1 / MOST_FREQUENT)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            hashes, numbers, _, _ = tokens(batch.column("_text"))
            times = np.bincount(numbers, minlength=len(hashes))
            some = np.flatnonzero(times >= limit / 4 * len(numbers))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[some].view(np.int64)), pa.array(times[some]), pa.array(np.full(len(some), len(numbers)))],
                ["word", "n", "of"],
            )

    glance = rows.filter(uniform("_id") * max(number, 1) < _LOOKED_AT + buckets)
    found = arrow_map(glance, look, "word long, n long, of long").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("of").alias("of")
    )
    found = found.filter(F.col("n") >= limit * F.col("of")).orderBy(F.desc("n"), "word").limit(MOST_FREQUENT)
    return np.sort(np.array([r[0] for r in found.collect()], np.int64).view(np.uint64))


class Scorer:
    """Looks up words and pairs in the mapped arrays."""

    def __init__(self, model: Model):
        self.model = model
        self.maps: OrderedDict[str, np.ndarray] = OrderedDict()

    def _array(self, name: str) -> np.ndarray:
        """A mapped array; the one that was not asked for longest makes way for it."""
        if name not in self.maps:
            while len(self.maps) >= MAPS:
                self.maps.popitem(last=False)
            self.maps[name] = _mapped(self.model.folder, name)
        self.maps.move_to_end(name)
        return self.maps[name]

    def _find(self, bucket: np.ndarray, keys: np.ndarray, name: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each bucket that is needed: its number, which keys it has, and their places in it."""
        order = np.lexsort([keys, bucket])  # sorted keys go through the pages of an array once
        needed, first = np.unique(bucket[order], return_index=True)
        for b, start, stop in zip(needed.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
            table = self._array(f"{name}-{b}").view("<u8")
            if len(table):
                some = order[start:stop]
                place = np.minimum(np.searchsorted(table, keys[some]), len(table) - 1)
                known = table[place] == keys[some]
                yield b, some[known], place[known]

    def _rows(self, keys: np.ndarray, hashes: str, stored: str, kind: np.dtype) -> np.ndarray:
        found = np.zeros(len(keys), kind)
        for b, some, place in self._find(_part_of(keys, self.model.buckets), keys, hashes):
            found[some] = self._array(f"{stored}-{b}").view(kind)[place]
        return found

    def word_rows(self, hashes: np.ndarray) -> np.ndarray:
        return self._rows(hashes, "hashes", "words", WORD)

    def context_rows(self, words: list[np.ndarray]) -> np.ndarray:
        """Of contexts of two words or more."""
        level = len(words) + 1
        return self._rows(gram_key(words), f"contexts{level}", f"sums{level}", CONTEXT)

    def gram_counts(self, words: list[np.ndarray]) -> np.ndarray:
        level, found = len(words), np.zeros(len(words[0]), np.int64)
        bucket = _bucket(words, self.model.frequent, self.model.buckets)
        for b, some, place in self._find(bucket, gram_key(words), f"keys{level}"):
            counts = self._array(f"counts{level}-{b}")
            width = 8 * len(counts) // len(self._array(f"keys{level}-{b}"))
            found[some] = counts.view(f"<u{width}")[place]
        return found

    def score(self, array: pa.Array) -> list[np.ndarray]:
        """Of each text: tokens, known tokens, base score and the model's score."""
        m = self.model
        hashes, numbers, begin, has_next = tokens(array)
        rows = self.word_rows(hashes)
        base = np.log10((rows["count"] + 1) / (m.train_tokens + m.types + 1))
        # Words after any word: continuation counts, interpolated with the same for all.
        before = rows["before"].astype(np.float64)
        d = np.array([0.0, *m.word_discounts])
        left = sum(x * y for x, y in zip(m.word_discounts, m.word_counts))
        chance = np.maximum(before - d[np.minimum(rows["before"], 3)], 0) / max(m.pairs, 1)
        chance += (left / m.pairs if m.pairs else 1.0) / (m.types + 1)
        found = grams(numbers, begin, has_next, m.order)
        which = found[-1]  # of the chances so far, that of each token
        for level in range(2, m.order + 1):
            own = found[-level:]
            at, now = _distinct(own, len(hashes))
            words = [hashes[column[at]] for column in own]
            sums = rows[own[0][at]] if level == 2 else self.context_rows(words[:-1])
            times, total = self.gram_counts(words), sums["total"].astype(np.float64)
            d = np.array([0.0, *m.gram_discounts[level]])
            freed = sum(x * sums[name] for x, name in zip(m.gram_discounts[level], ("once", "twice", "more")))
            shorter, seen = chance[which[at]], total > 0
            total[~seen] = 1
            kept = np.maximum(times - d[np.minimum(times, 3)], 0) / total
            chance, which = np.where(seen, kept + freed / total * shorter, shorter), now
        n = len(array)
        owner = np.repeat(np.arange(n), np.diff(begin) - 1)
        return [
            np.bincount(owner, minlength=n),
            np.bincount(owner, rows["count"][found[-1]] > 0, minlength=n).astype(np.int64),
            np.bincount(owner, base[found[-1]], minlength=n),
            np.bincount(owner, np.log10(chance)[which], minlength=n),
        ]


def score(df: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, `n_tokens`, `n_known`, `base_score`, `score` and `perplexity` of every row.

    Scores are log10 probabilities of the lower-cased words and the end after
    them; null text is empty and has the end alone. Repeated rows stay rows; an
    empty table gives none.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in slices(batches, "_text", STEP, 1 << 16):
            scorer = scorer or Scorer(model)
            n, known, base, found = scorer.score(batch.column("_text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *map(pa.array, (n, known, base, found, 10 ** (-found / n)))],
                ["_id", "n_tokens", "n_known", "base_score", "score", "perplexity"],
            )

    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    schema = f"_id {kind}, n_tokens long, n_known long, base_score double, score double, perplexity double"
    return arrow_map(rows, compute, schema).withColumnRenamed("_id", id_column)

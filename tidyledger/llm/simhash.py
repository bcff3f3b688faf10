"""SimHash near-duplicates by a grid over segment bit counts.

A fingerprint of 64 bits is seen as the numbers of set bits in its segments of
two bits. The Manhattan distance of two such vectors is at most the number of
differing bits, so fingerprints within the bit limit are close in the grid of
these vectors. The vector is split into parts of which at least one differs by
two or less; a fingerprint is registered, for every part, in its own cell and in
each neighbouring cell, and two that differ by two or less share a cell. What
shares a cell is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.common import Words, arrow_map, checkpointed, slices
from tidyledger.llm.graph import components
from tidyledger.llm.skew import lookup

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
COMMON = 4096  # fingerprints of the most rows that are broadcast with their components
CELL_LIMIT = 8192  # fingerprints of one cell that are compared in one task
_SEGMENTS = 32  # of two bits each


def _normalised(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Lower-cased words with one space between; where each begins and ends."""
    follows = np.zeros(len(words.data), dtype=bool)
    after = words.ends[words.ends < len(words.data)]
    follows[after[~words.inside[after]]] = True
    kept = words.inside | follows
    text = np.where(words.inside, words.lower(), np.uint8(0x20))[kept]
    position = np.cumsum(kept) - 1
    return text.tobytes(), position[words.starts], position[words.ends - 1] + 1


def simhash_batch(array: pa.Array, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Fingerprints (unsigned 64-bit) of the texts."""
    words = Words(array)
    text, starts, ends = _normalised(words)
    per_text = np.where(words.counts >= shingle_words, words.counts - shingle_words + 1, np.minimum(words.counts, 1))
    first = np.concatenate([[0], np.cumsum(per_text)])
    owner = np.repeat(np.arange(len(array)), per_text)
    begin_word = words.first[owner] + np.arange(first[-1]) - first[owner]
    end_word = np.minimum(begin_word + shingle_words, words.first[owner + 1]) - 1
    hash_of, view = xxhash.xxh64_intdigest, memoryview(text)
    hashes = np.fromiter(
        (hash_of(view[a:b], SEED) for a, b in zip(starts[begin_word].tolist(), ends[end_word].tolist())),
        np.uint64,
        int(first[-1]),
    )
    result = np.zeros(len(array), np.uint64)
    some = np.flatnonzero(per_text)
    if len(some):
        set_bits = np.zeros((len(some), 64), np.int64)
        step = 1 << 17  # shingles whose bits are spread out at once
        for at in range(0, len(hashes), step):
            part = hashes[at : at + step]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            low = int(np.searchsorted(first[some], at, side="right")) - 1
            high = int(np.searchsorted(first[some], at + len(part), side="left"))
            cuts = np.maximum(first[some[low:high]] - at, 0)
            set_bits[low:high] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
        ones = (2 * set_bits > per_text[some][:, None]).astype(np.uint8)
        result[some] = np.packbits(ones, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return result


def fingerprints(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The id and `fp`, the fingerprint as a signed long, for every row; null text is empty.

    `carry` names columns of text to take along.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = simhash_batch(batch.column("_text"), shingle_words).view(np.int64)
            taken = [batch.column(name) for name in ["_id", *carry]]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(found)], ["_id", *carry, "fp"])

    rows = df.select(F.col(id_column).alias("_id"), *carry, F.col(text_column).alias("_text"))
    kind = df.schema[id_column].dataType.simpleString()
    carried = "".join(f", {name} string" for name in carry)
    return arrow_map(rows, compute, f"_id {kind}{carried}, fp long").withColumnRenamed("_id", id_column)


def cells_of(fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cell and position of the fingerprint, for its own cell and the neighbours in every part."""
    parts = -(-(max_bits + 1) // 3)  # the least number of parts of which one differs by two or less
    shifts = np.arange(0, 64, 2, dtype=np.uint64)
    counts = np.bitwise_count((fps[:, None] >> shifts[None, :]) & np.uint64(3)).astype(np.int64)
    here = np.arange(len(fps))
    for part, columns in enumerate(np.array_split(np.arange(_SEGMENTS), parts)):
        weight = 3 ** np.arange(len(columns), dtype=np.int64)
        own = counts[:, columns] @ weight * parts + part
        yield own, here
        for column, w in zip(columns.tolist(), (weight * parts).tolist()):
            for step, edge in ((1, 2), (-1, 0)):
                inside = np.flatnonzero(counts[:, column] != edge)
                yield own[inside] + step * w, inside


def _registered(distinct: DataFrame, max_bits: int) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                fps = batch.column("fp").slice(start, 4096).to_numpy(zero_copy_only=False)
                found = list(cells_of(fps.view(np.uint64), max_bits))
                cell, at = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(fps[at])], ["cell", "fp"])

    return arrow_map(distinct.select("fp"), compute, "cell long, fp long")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer edges with the same components: each node to the least of its component."""
    nodes, ids = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ids[: len(a)], ids[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        np.minimum.at(new, root[left], least)
        np.minimum.at(new, root[right], least)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    some = root != np.arange(len(nodes))
    return nodes[some], nodes[root[some]]


def _links_in_runs(cell: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links between fingerprints of equal cells, which stand together."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    held = 0
    here = np.flatnonzero(cell[1:] == cell[:-1])
    ahead = 1
    while len(here):
        near = here[np.bitwise_count((fp[here] ^ fp[here + ahead]).view(np.uint64)) <= max_bits]
        a.append(fp[near])
        b.append(fp[near + ahead])
        held += len(near)
        if held > 1 << 19:
            x, y = _forest(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], 0
        ahead += 1
        here = here[here + ahead < len(cell)]
        here = here[cell[here] == cell[here + ahead]]
    return _forest(np.concatenate(a), np.concatenate(b))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within the bit limit.

    Only links verified on 64 bits are used; of those within a step of work a
    spanning forest is given, never all pairs. A cell with more than `cell_limit`
    fingerprints is cut into blocks, and every two of its blocks meet in a group
    of their own, so that a task never holds a larger cell.
    """
    registered = _registered(distinct, max_bits)
    large = (
        registered.groupBy("cell")
        .count()
        .filter(F.col("count") > cell_limit)
        .select("cell", F.ceil(F.col("count") / cell_limit).cast("int").alias("blocks"))
    )
    block = F.pmod(F.hash("fp"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1))
    grouped = (
        registered.join(large, "cell", "left")
        .select("cell", "fp", F.coalesce(block, F.lit(0)).alias("block"), other.alias("other"))
        .select(
            F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other")).alias("cell"), "fp"
        )
        .repartition("cell")
        .sortWithinPartitions("cell", "fp")
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, fps = [], []

        def linked(upto_end: bool) -> Iterator[pa.RecordBatch]:
            cell, fp = np.concatenate(cells), np.concatenate(fps)
            # The last cell may go on in the next batch.
            stop = len(cell) if upto_end else int(np.searchsorted(cell, cell[-1]))
            cells[:], fps[:] = [cell[stop:]], [fp[stop:]]
            a, b = _links_in_runs(cell[:stop], fp[:stop], max_bits)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if batch.num_rows:
                cells.append(batch.column("cell").to_numpy(zero_copy_only=False))
                fps.append(batch.column("fp").to_numpy(zero_copy_only=False))
                if sum(map(len, cells)) > 1 << 17:
                    yield from linked(False)
        if cells:
            yield from linked(True)

    return arrow_map(grouped, compute, "a long, b long")


def simhash_near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The id, `fingerprint` (16 hex digits) and `component_id` of every row.

    `carry` names columns of text to take along.

    Fingerprints link at `max_bits` or fewer differing bits; `component_id` is the
    smallest id that is reachable over links, the row's own included. Null text is
    empty; a text without words has the fingerprint zero and is linked like any
    other. Null ids are ignored where another id is reachable. Repeated rows stay
    rows. An empty table gives no rows.
    """
    marked = checkpointed(fingerprints(df, id_column, text_column, shingle_words, carry))
    distinct = checkpointed(marked.groupBy("fp").agg(F.min(id_column).alias("least"), F.count("*").alias("n")))
    roots = checkpointed(components(links(distinct, max_bits)).select(F.col("node").alias("fp"), "root"))
    linked = distinct.join(roots, "fp")
    least = checkpointed(linked.groupBy("root").agg(F.min("least").alias("least"), F.count("*").alias("n")))
    moved = lookup(roots, least, "root").select("fp", F.col("least").alias("reached"))
    per_fp = checkpointed(
        distinct.join(moved, "fp", "left").select("fp", "n", F.coalesce("reached", "least").alias("component_id"))
    )
    # The fingerprints of most rows are sent to the rows; the others meet by a shuffle.
    common = F.broadcast(per_fp.filter("n > 1").orderBy(F.desc("n"), "fp").limit(COMMON).drop("n"))
    with_common = marked.join(common, "fp", "left")
    missing = with_common.filter("component_id is null").drop("component_id").join(per_fp.drop("n"), "fp")
    found = with_common.filter("component_id is not null").unionByName(missing)
    return found.select(
        id_column, *carry, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

"""Hard negatives by shared lists of anchor clusters (in the manner of MAXIMUS).

Anchors are clustered by direction. For a cluster with centre c whose members lie
within the angle t of it, no member u can score more with a vector v than
|u| |v| cos(max(0, angle(c, v) - t)). Leaving out |u|, this bound puts the
candidates in one order for the whole cluster; it is computed and sorted once,
and every member walks down that list until the bound certifies that nothing
further down can enter its result. The result is exact; clusters only decide how
soon a walk may end.

Candidates stay where they are read. A task holds a part of them of bounded size
and goes through the anchors in files of bounded size in the shared folder, one
in memory at a time. What a part contributes to an anchor, a few rows, is merged
by a ranking that is cut before the shuffle. Two rounds: the positives of every
anchor, then the negatives that their scores allow.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyledger.llm.common import arrow_map
from tidyledger.llm.shared import Blocks, load_arrays, new_folder, store_arrays, written
from tidyledger.llm.whitening import fixed_point, matrix, usable

POSITIVES = 5
NEGATIVES = 10
LEAST, MOST = 30, 90  # per cent of the positive's score that a negative may have
SAMPLE = 4096  # anchors whose directions place the centres, at most
PER_CLUSTER = 64  # anchors for each centre
CLUSTERS = 256  # centres at most
BLOCK = 512  # anchors of a cluster in one file, at most
PIECE = 8192  # anchors of a cluster that are gathered in one task, about
PART_BYTES = 32 << 20  # candidates in memory at once, as doubles
PART_ROWS = 1 << 16
SLAB = 1024  # candidates that are scored together on the way down a list
_TURNS = 10  # of the clustering


def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zero for a zero vector) and lengths."""
    x = x.astype(np.float64)
    length = np.sqrt((x * x).sum(axis=1))
    return x / np.maximum(length, 1e-300)[:, None], length


def _nearest(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (units @ centres.T).argmax(axis=1)


def centres_of(x: np.ndarray, number: int) -> np.ndarray:
    """Unit centres by spherical k-means from evenly drawn vectors."""
    units, _ = _directions(x)
    centres = units[np.linspace(0, len(units) - 1, min(number, len(units))).astype(int)]
    for _ in range(_TURNS):
        nearest = _nearest(units, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        moved, length = _directions(sums)
        centres = np.where(length[:, None] > 0, moved, centres)
    return centres


def _cone(x: np.ndarray) -> tuple[np.ndarray, float]:
    """A centre of the vectors, and the largest angle of one to it."""
    units, length = _directions(x)
    centre, far = _directions(units.sum(axis=0)[None, :])
    if not far[0]:
        return units[0], math.pi
    some = units[length > 0] @ centre[0]
    # The cosine is rounded; near zero that is some 1e-8 of the angle.
    return centre[0], float(np.arccos(np.clip(some, -1, 1)).max(initial=0.0)) + 1e-7


@dataclass
class Part:
    """Candidates of one part, and what all anchors need of them."""

    x: np.ndarray
    ids: np.ndarray
    named: np.ndarray  # whether the id is not null
    labels: np.ndarray

    def __post_init__(self):
        self.units, self.length = _directions(self.x)
        order = np.lexsort([self.ids, ~self.named])
        self.later = np.empty(len(order), np.int64)  # greater for what comes first among equal scores
        self.later[order] = np.arange(len(order))[::-1]
        self.kinds, self.label = np.unique(self.labels, return_inverse=True)

    def shared_list(self, centre: np.ndarray, angle: float) -> tuple[np.ndarray, np.ndarray]:
        """The candidates by falling bound, and the bounds for members of length 1."""
        off = np.arccos(np.clip(self.units @ centre, -1, 1)) - angle
        bound = self.length * (np.cos(np.maximum(off, 0)) + 1e-9)
        order = np.argsort(-bound, kind="stable")
        return order, bound[order]


class Best:
    """The `k` best candidates of each of (members x limits), as one whole number each.

    A number is score * rows + place, so that of equal scores the smaller id is
    the greater. Whole numbers of Python where a long is too small for them.
    """

    def __init__(self, members: int, limits: int, k: int, rows: int, kind: type):
        self.rows, self.none = rows, -(2**62) if kind is np.int64 else -(2**400)
        self.keys = np.full((members, limits, k), self.none, kind)

    def add(self, members: np.ndarray, scores: np.ndarray, place: np.ndarray, allowed: np.ndarray) -> None:
        """`scores` (members x candidates); `allowed` (members x limits x candidates)."""
        keys = (scores * self.rows + place)[:, None, :]
        better = allowed & (keys > self.keys[members].min(axis=2)[:, :, None])
        member, limit = np.nonzero(better.any(axis=2))
        if len(member):
            new = np.where(better[member, limit], np.broadcast_to(keys, better.shape)[member, limit], self.none)
            held = np.concatenate([self.keys[members[member], limit], new], axis=1)
            k = self.keys.shape[2]
            self.keys[members[member], limit] = np.partition(held, held.shape[1] - k, axis=1)[:, -k:]

    def last(self) -> np.ndarray:
        """The score that a candidate must reach, -inf while there are fewer than k."""
        least = self.keys.min(axis=2)
        return np.where(least == self.none, -np.inf, (least // self.rows).astype(float))

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Member, limit, score and place of all that are there."""
        member, limit, k = np.nonzero(self.keys != self.none)
        keys = self.keys[member, limit, k]
        return member, limit, keys // self.rows, (keys % self.rows).astype(np.int64)


class Anchors:
    """The anchors of one file, with the scores of their positives in the second round."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.key, self.x = int(arrays["key"][0]), arrays["x"]
        self.ids, self.labels = arrays["ids"], arrays["labels"]
        self.length = _directions(self.x)[1]
        self.centre, self.angle = _cone(self.x)
        self.scores, self.given = arrays.get("scores"), arrays.get("given")

    def _exact(self, part: Part) -> type:
        """The kind of number that holds all scores of the part with its places."""
        largest = [max(int(a.max(initial=0)), -int(a.min(initial=0))) for a in (self.x, part.x)]
        return np.int64 if largest[0] * largest[1] * self.x.shape[1] < 2**45 else object

    def walk(self, part: Part, k: int) -> Best:
        """Down the shared list: the best others of the own label, or, with scores of positives,
        for each of them the best of another label within its limits."""
        kind = self._exact(part)
        limits = 1 if self.scores is None else self.scores.shape[1]
        best = Best(len(self.ids), limits, k, PART_ROWS, kind)
        own = np.searchsorted(part.kinds, self.labels)
        known = part.kinds[np.minimum(own, len(part.kinds) - 1)] == self.labels
        own = np.where(known, own, -1)
        if self.scores is None:
            floor = np.full((len(self.ids), 1), -np.inf)
        else:
            low, high = LEAST * self.scores.astype(kind), MOST * self.scores.astype(kind)
            # Nothing lies between the limits of a negative score.
            floor = np.where(self.given & (self.scores >= 0), low.astype(float) / 100, np.inf)
        order, bound = part.shared_list(self.centre, self.angle)
        x = part.x.astype(object) if kind is object else part.x.astype(np.float64)
        mine = self.x.astype(object) if kind is object else self.x.astype(np.float64)
        active = np.arange(len(self.ids))
        for start in range(0, len(order), SLAB):
            # What is still to come reaches at most `upper`.
            last = np.maximum(best.last()[active], floor[active]).min(axis=1)
            upper = bound[start] * self.length[active]
            active = active[upper + 1e-9 * np.abs(upper) + 1e-6 >= last]
            if not len(active):
                break
            some = order[start : start + SLAB]
            scores = (mine[active] @ x[some].T).astype(kind)
            same = own[active][:, None] == part.label[some][None, :]
            if self.scores is None:
                other = ~part.named[some][None, :] | (self.ids[active][:, None] != part.ids[some][None, :])
                allowed = (same & other)[:, None, :]
            else:
                hundred = (100 * scores)[:, None, :]
                allowed = (low[active][:, :, None] <= hundred) & (hundred <= high[active][:, :, None])
                allowed = allowed.astype(bool) & self.given[active][:, :, None] & ~same[:, None, :]
            best.add(active, scores, part.later[some], allowed)
        return best


def _parts(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[Part]:
    """The candidates of a task in parts of bounded size."""
    most, held, rows = max(1, min(PART_ROWS, PART_BYTES // (8 * dimension))), [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            piece = batch.slice(start, most)
            if rows + piece.num_rows > most:
                yield _part(held, dimension)
                held, rows = [], 0
            held.append(piece)
            rows += piece.num_rows
    if rows:
        yield _part(held, dimension)


def _part(held: list[pa.RecordBatch], dimension: int) -> Part:
    x = np.concatenate([matrix(b.column("x"), dimension) for b in held])
    ids = pa.chunked_array([b.column("_id") for b in held])
    labels = np.array([label for b in held for label in b.column("_label").to_pylist()])
    return Part(x, ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(), labels)


def _search(rows: DataFrame, dimension: int, folder: str, names: list, k: int) -> DataFrame:
    """`block`, `member`, `limit`, `score`, `_id`: the best of every part for every anchor."""
    fields = ["block", "member", "limit", "score", "_id"]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(folder, names)
        for part in _parts(batches, dimension):
            at = np.empty(len(part.later), np.int64)
            at[part.later] = np.arange(len(at))
            for anchors in blocks.each(Anchors):
                member, limit, score, later = anchors.walk(part, k).found()
                row = at[later]
                columns = [np.full(len(member), anchors.key), member.astype(np.int32), limit.astype(np.int32)]
                ids = pa.array(part.ids[row], mask=~part.named[row])
                score = pa.array(score.tolist(), pa.int64())
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), score, ids], fields)

    return arrow_map(rows, compute, "block long, member int, limit int, score long, _id long")


def _ranked(found: DataFrame, keys: list[str], k: int, rank: str) -> DataFrame:
    """The first `k` rows of each key by score and id; Spark cuts them before the shuffle too."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("_id").asc_nulls_last())
    return found.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def _write_anchors(rows: DataFrame, is_anchor: Column, dimension: int, folder: str) -> DataFrame:
    """Anchors in files by cluster; a row with `block`, `name`, `member` and `anchor_id` for each."""
    anchors = rows.filter(is_anchor).select("_id", "_label", "x")
    number = anchors.count()
    sample = anchors.orderBy(F.xxhash64("_id"), "_id", "x").limit(SAMPLE).select("x").collect()
    clusters = min(CLUSTERS, math.ceil(number / PER_CLUSTER))
    centres = centres_of(np.array([r[0] for r in sample], np.int64).reshape(-1, dimension), clusters) if sample else None

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = _nearest(_directions(matrix(batch.column("x"), dimension))[0], centres)
            yield batch.append_column("cluster", pa.array(cluster.astype(np.int32)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def flushed() -> pa.RecordBatch:
            part = _part(held, dimension)
            key = uuid.uuid4().int >> 65
            arrays = {"key": np.array([key]), "x": part.x, "ids": part.ids, "labels": part.labels}
            name = store_arrays(folder, arrays)
            n = len(part.ids)
            columns = [np.full(n, key), [name] * n, np.arange(n, dtype=np.int32), part.ids]
            return pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["block", "name", "member", "anchor_id"])

        for batch in batches:
            for cluster, start, stop in _runs(batch.column("cluster").to_numpy(), BLOCK):
                if held and (cluster != now or sum(b.num_rows for b in held) + stop - start > BLOCK):
                    yield flushed()
                    held = []
                held.append(batch.slice(start, stop - start))
                now = cluster
        if held:
            yield flushed()

    placed = arrow_map(anchors, assign, "_id long, _label string, x array<long>, cluster int")
    pieces = math.ceil(number / PIECE) or 1
    placed = placed.repartition(max(1, clusters, pieces), "cluster", F.pmod(F.xxhash64("_id"), F.lit(pieces)))
    placed = placed.sortWithinPartitions("cluster", "_id")
    return written(arrow_map(placed, write, "block long, name string, member int, anchor_id long"), "anchors")


def _runs(values: np.ndarray, most: int) -> Iterator[tuple[int, int, int]]:
    """Runs of equal values with at most `most` of them: value, begin and end."""
    cuts = np.flatnonzero(np.diff(values)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]):
        for start in range(a, b, most):
            yield int(values[start]), start, min(start + most, b)


def _write_limits(anchors: DataFrame, positives: DataFrame, folder: str, number: int) -> list[str]:
    """Files of anchors with the scores of their positives; the names."""
    known = anchors.join(positives, ["block", "member"]).groupBy("block", "name").agg(
        F.sort_array(F.collect_list(F.struct("member", "limit", "score"))).alias("found")
    )  # a block has a bounded number of anchors, each of few positives

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, found in zip(batch.column("name").to_pylist(), batch.column("found").to_pylist()):
                arrays = load_arrays(folder, name)
                shape = (len(arrays["ids"]), number)
                scores, given = np.zeros(shape, np.int64), np.zeros(shape, bool)
                place = [f["member"] for f in found], [f["limit"] for f in found]
                scores[place], given[place] = [f["score"] for f in found], True
                made = store_arrays(folder, arrays | {"scores": scores, "given": given})
                yield pa.RecordBatch.from_arrays([pa.array([made])], ["made"])

    return [r[0] for r in arrow_map(known.select("name", "found"), write, "made string").collect()]


def mine(
    df: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`.

    Scores are inner products of the vectors in whole numbers of 1/256. Anchors are
    the rows of which `is_anchor`, a condition on `df`, is true. The positives of an
    anchor are the first rows of its label by falling score, of equal ones by id
    (null last); rows with its own id are not among them. The negatives for a
    positive are the first rows of other labels whose score is at least 30 and at
    most 90 per cent of the positive's. Anchors or positives without negatives give
    no rows.

    Ids are whole numbers. Rows with a null label, a null vector or null or
    non-finite entries take no part, nor do vectors of another length than most
    (of two lengths as frequent, the shorter). Rows with a null id are no anchors.
    Repeated rows are rows of their own: as anchors they give their results again,
    as candidates they follow one another. A score must fit a long. A table without
    rows, or without anchors, gives none. Other columns are not read.
    """
    vector = F.col(vector_column)
    rows = df.filter(usable(vector) & F.col(label_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("_id"),
        F.col(label_column).cast("string").alias("_label"),
        fixed_point(vector).alias("x"),
        F.coalesce(is_anchor & F.col(id_column).isNotNull(), F.lit(False)).alias("_anchor"),
    )
    lengths = rows.filter(F.size("x") > 0).groupBy(F.size("x").alias("d")).count()
    most = lengths.orderBy(F.desc("count"), "d").first()
    dimension = most["d"] if most else 1
    rows = rows.filter(F.size("x") == dimension)
    slim = rows.select("_id", "_label", "x")
    folder = new_folder(df.sparkSession, "hard-negatives")

    anchors = _write_anchors(rows, F.col("_anchor"), dimension, folder)
    names = sorted(r[0] for r in anchors.select("name").distinct().collect())
    found = _search(slim, dimension, folder, names, positives)
    ranked = _ranked(found.drop("limit"), ["block", "member"], positives, "place")
    first = written(ranked.withColumn("limit", F.col("place") - 1).drop("place"), "positives")

    named = _write_limits(anchors, first, folder, positives)
    found = _search(slim, dimension, folder, named, negatives)
    ranked = _ranked(found, ["block", "member", "limit"], negatives, "rank")
    of = first.join(anchors, ["block", "member"]).select(
        "block", "member", "limit", "anchor_id", F.col("_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return ranked.join(of, ["block", "member", "limit"]).select(
        "anchor_id", "positive_id", "rank", F.col("_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )

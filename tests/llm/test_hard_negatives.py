from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidyledger.llm import hard_negatives
from tidyledger.llm.hard_negatives import Anchors, Part

SCHEMA = "vec_id long, embedding array<float>, label string, rank string, x string, _id string, member int"


def fixed(v):
    return [math.floor(256 * float(np.float32(c))) for c in v]


def brute(rows, every, positives=5, negatives=10):
    """All scores of all anchors, sorted."""
    def valid(v, label):
        return label is not None and v is not None and v and all(c is not None and math.isfinite(c) for c in v)

    rows = [(i, fixed(v), label) for i, v, label in rows if valid(v, label)]
    found = []
    for i, x, label in rows:
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(x, y)), j, other) for j, y, other in rows if j is None or j != i]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for score, j, _ in [s for s in scored if s[2] == label][:positives]:
            some = [s for s in scored if s[2] != label and 30 * score <= 100 * s[0] <= 90 * score][:negatives]
            found += [(i, j, k + 1, n, score, s) for k, (s, n, _) in enumerate(some)]
    return found


def run(spark, rows, every=5, **options):
    df = spark.createDataFrame([(*r, "a", None, "b", 7) for r in rows], SCHEMA).repartition(3)
    found = hard_negatives.mine(df, F.col("vec_id") % every == 0, **options)
    assert found.dtypes == [
        ("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
        ("positive_score", "bigint"), ("negative_score", "bigint"),
    ]
    return [tuple(r) for r in found.collect()]


def by_text(rows):
    return sorted(map(str, rows))


def clustered(n, seed, d=8, labels=4, spread=0.6):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((labels, d))
    label = draw.integers(0, labels, n)
    vectors = centres[label] + spread * draw.standard_normal((n, d))
    flipped = np.where(draw.random(n) < 0.3, draw.integers(0, labels, n), label)
    return [(i, v, f"l{k}") for i, (v, k) in enumerate(zip(vectors.tolist(), flipped.tolist()))]


@pytest.mark.parametrize("spread", [0.05, 0.6, 3.0])
def test_against_brute_force(spark, monkeypatch, spread):
    """Small slabs, parts, files and pieces, so that walks end early and results are merged."""
    monkeypatch.setattr(hard_negatives, "SLAB", 7)
    monkeypatch.setattr(hard_negatives, "PART_ROWS", 1 << 6)
    monkeypatch.setattr(hard_negatives, "BLOCK", 5)
    monkeypatch.setattr(hard_negatives, "PIECE", 9)
    monkeypatch.setattr(hard_negatives, "PER_CLUSTER", 4)
    rows = clustered(400, 3, spread=spread)
    wanted = brute(rows, 5)
    assert len(wanted) > 100
    assert by_text(run(spark, rows)) == by_text(wanted)


def test_ties_copies_nulls_and_bad_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(60, 5, d=3)
    rows += [(i, [1.0, 0.5, 0.25], f"l{i % 3}") for i in range(100, 160)]  # one vector, many ids
    rows += [(i, [0.7, 0.35, 0.25], f"l{i % 3}") for i in range(160, 220)]
    rows += [rows[7]] * 3 + [(None, [1.0, 0.5, 0.25], "l0"), (None, [0.9, 0.1, 0.1], "l1"), (300, [0.0, 0.0, 0.0], "l0")]
    rows += [(301, [0.0, 0.0, 0.0], "l0"), (302, [0.0, 0.0, 0.0], "l1"), (305, [-1.0, -1.0, -1.0], "l9"), (306, [1.0, 1.0, 1.0], "l9")]
    bad = [(400, None, "l0"), (405, [nan, 1.0, 1.0], "l0"), (410, [inf, 1.0, 1.0], "l1"), (415, [1.0, None, 1.0], "l1")]
    bad += [(420, [1.0, 1.0, 1.0], None), (425, [], "l0"), (430, [1.0], "l0"), (435, [1.0] * 5, "l0")]
    wanted = brute(rows, 5)
    assert by_text(run(spark, rows + bad)) == by_text(wanted)


def test_repeated_anchors_give_their_rows_again(spark):
    rows = [(0, [1.0, 0.0], "a"), (0, [1.0, 0.0], "a"), (1, [1.0, 0.0], "a"), (2, [0.5, 0.5], "b")]
    assert run(spark, rows, 10) == [(0, 1, 1, 2, 65536, 32768)] * 2


def test_without_rows_or_anchors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0, 0.0], "a"), (2, [0.5, 0.5], "b")]) == []
    assert run(spark, [(5, None, "a"), (10, [1.0], None)]) == []
    assert run(spark, [(5, [1.0], "a")]) == []


def test_large_scores(spark):
    rows = [(i, [1e5 * v for v in x], label) for i, x, label in clustered(80, 9)]
    assert by_text(run(spark, rows)) == by_text(brute(rows, 5))


def test_a_walk_ends_before_the_list_does(monkeypatch):
    """The bound holds for every member, and close anchors look at few candidates."""
    draw = np.random.default_rng(2)
    x = (256 * draw.standard_normal((4000, 4))).astype(np.int64)
    part = Part(x, np.arange(4000), np.ones(4000, bool), np.array(["a", "b"])[np.arange(4000) % 2])
    some = np.flatnonzero(part.units @ part.units[0] > 0.97)[:20]
    anchors = Anchors({"key": np.array([1]), "x": x[some], "ids": some, "labels": part.labels[some]})
    order, bound = part.shared_list(anchors.centre, anchors.angle)
    assert (np.diff(bound) <= 0).all()
    scores = x[some].astype(float) @ x[order].T.astype(float)
    assert (scores <= anchors.length[:, None] * bound[None, :] * (1 + 1e-9) + 1e-6).all()
    looked = []
    real = hard_negatives.Best.add
    monkeypatch.setattr(hard_negatives, "SLAB", 50)
    monkeypatch.setattr(hard_negatives.Best, "add", lambda self, m, s, *rest: looked.append(s.shape[1]) or real(self, m, s, *rest))
    anchors.walk(part, 5)
    assert sum(looked) <= 1000

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidyledger.llm import whitening
from tidyledger.llm.queries import queries
from tidyledger.llm.spectrum import Factors, Slicer, leading

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, x string, _id string"


def symmetric(values, seed):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10**6), st.floats(-2, 2))
def test_inertia_counts_eigenvalues(n, seed, shift):
    a = symmetric(np.random.default_rng(seed).standard_normal(n), seed)
    values = np.linalg.eigvalsh(a)
    if np.abs(values - shift).min() > 1e-9:
        assert Factors(a, shift).positive() == (values > shift).sum()
        b = np.random.default_rng(seed + 1).standard_normal(n)
        assert np.allclose((a - shift * np.eye(n)) @ Factors(a, shift).solve(b), b, atol=1e-6)


def test_inertia_of_matrices_with_zeros():
    assert Factors(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0).positive() == 1
    assert Factors(np.zeros((3, 3)), 0.0).positive() == 0
    assert Factors(np.eye(3), 1.0).positive() == 0
    assert Factors(np.eye(3), 0.5).positive() == 3
    wide = np.zeros((5, 5))
    wide[0, 1:] = wide[1:, 0] = 1.0
    assert Factors(wide, 0.0).positive() == 1


@pytest.mark.parametrize(
    "values",
    [
        [9, 4, 2, 1, 0.5, 0.1],
        [1, 1, 1, 1, 1, 1],  # all equal
        [5, 5, 5, 1, 1, 0],
        [1, 1 - 1e-9, 1 - 2e-9, 1 - 1e-15, 0.3, 0.2],
        [1e12, 1e6, 1, 1e-6, 0, 0],
        [3, 0, 0, 0, 0, 0],
        [1.001, 1.0005, 1.0004, 1.00039, 1.00038, 1.00037],
    ],
)
def test_leading_eigenpairs(values):
    a = symmetric(np.array(values, float), 3)
    found, vectors = leading(a, 4)
    wanted = np.sort(np.linalg.eigvalsh(a))[::-1]
    rounding = 8 * np.finfo(float).eps * len(a) * np.abs(a).sum(axis=1).max()
    assert len(found) == min(4, (wanted > rounding).sum())
    assert np.abs(found - wanted[: len(found)]).max() <= rounding
    assert (np.diff(found) <= rounding).all()
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-10
    assert np.abs(a @ vectors - vectors * found).max() <= 4 * rounding
    assert all(Slicer(a).certified(j + 1, v) for j, v in enumerate(found))


def test_an_eigenvalue_of_another_number_is_not_certified():
    a = symmetric(np.array([5.0, 3.0, 2.0, 1.0]), 1)
    slicer = Slicer(a)
    assert slicer.certified(2, 3.0) and not slicer.certified(1, 3.0) and not slicer.certified(3, 3.0)
    low, high = slicer.isolate(2, slicer.width, slicer.norm)
    assert low < 3 < high and slicer.above(low) == 2 and slicer.above(high) == 1


def fixed(vectors):
    return [[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors]


def compare(found, ids, vectors, k=4):
    """Against Python's whole numbers and numpy's eigenvalues."""
    x = fixed(vectors)
    distinct = sorted(set(map(tuple, x)))
    n, d = len(distinct), len(distinct[0])
    sums = [sum(v[i] for v in distinct) for i in range(d)]
    away = np.array([[float(n * v - s) / n for v, s in zip(row, sums)] for row in distinct])
    cov = away.T @ away / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    by_row: dict = {}
    for r in found:
        by_row.setdefault((r.vec_id, r.deviation), []).append(r)
    assert len(found) == len(ids) * k
    for i, v in zip(ids, x):
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        rows = [r for r in by_row[(i, deviation)] if True]
        for r in rows:
            assert r.n == n
            assert r.identity_error <= 1e-9
            e = values[r.component - 1]
            assert r.explained == pytest.approx(e / values.sum(), rel=1e-9)
    # One sign for each component.
    for j in range(k):
        wanted = {i: (np.array([n * c - s for c, s in zip(v, sums)]) / n) @ axes[:, j] / math.sqrt(values[j]) for i, v in zip(ids, x)}
        got = {r.vec_id: r.whitened for r in found if r.component == j + 1}
        sign = 1 if sum(wanted[i] * got[i] for i in got) > 0 else -1
        assert max(abs(wanted[i] - sign * got[i]) for i in got) < 1e-8


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", None, "z") for i, v in rows], SCHEMA).repartition(3)


def run(df, **options):
    return whitening.transform(df, whitening.fit(df, **options)).collect()


def test_against_numpy(spark):
    draw = np.random.default_rng(1)
    vectors = (draw.standard_normal((300, 6)) * [3, 2, 1, 0.5, 0.2, 0.1] + 5).tolist()
    vectors += vectors[:40] + [vectors[0]] * 200  # a large group of equal ones
    ids = list(range(len(vectors)))
    compare(run(frame(spark, list(zip(ids, vectors)))), ids, vectors)


def test_rows_that_do_not_count(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0, -0.0]), (2, [0.5, 0.1, 3.0]), (None, [2.0, 2.0, 2.5]), (4, [-1.0, 0.0, 0.25]), (4, [-1.0, 0.0, 0.25])]
    bad = [(5, None), (6, [1.0, None, 2.0]), (7, [nan, 1.0, 2.0]), (8, [inf, 1.0, 2.0]), (9, [1.0, -inf, 2.0]), (10, [])]
    bad += [(11, [1.0]), (12, [1.0, 2.0, 3.0, 4.0])]
    found = run(frame(spark, good + bad))
    assert sorted(str(r.vec_id) for r in found) == sorted(str(i) for i, _ in good for _ in range(3))  # three dimensions
    assert {r.n for r in found} == {4}
    alone = run(frame(spark, good))
    assert {(r.vec_id, r.component, r.deviation) for r in found} == {(r.vec_id, r.component, r.deviation) for r in alone}


def test_without_components(spark):
    assert run(frame(spark, [])) == []
    assert run(frame(spark, [(1, None)])) == []
    assert run(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])) == []  # no variance
    line = run(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)]))
    assert {r.component for r in line} == {1} and line[0].explained == pytest.approx(1.0)


def test_large_entries_are_exact_or_null(spark):
    vectors = [[3e3 * i, 1.5e3 * (i % 7), -2e3 * (i * i % 11)] for i in range(50)]
    compare(run(frame(spark, list(enumerate(vectors)))), list(range(50)), vectors, k=3)
    huge = run(frame(spark, [(i, [3e30 * i, -1e38 * (i % 3), float(i)]) for i in range(6)]))
    assert {r.n for r in huge} == {5} or {r.n for r in huge} == {6}
    assert all(r.deviation is None for r in huge)
    assert all(math.isfinite(r.whitened) and r.identity_error < 1e-4 for r in huge)


def test_query(spark, sample):
    found = queries()["op12_whitening"](spark, sample).collect()
    rows = spark.read.parquet(f"{sample}/embeddings.parquet").collect()
    compare(found, [r.vec_id for r in rows], [r.embedding for r in rows])
    again = queries()["op12_whitening"](spark, sample).collect()
    key = lambda r: (r.vec_id, r.component, r.whitened)
    assert sorted(map(key, found)) == sorted(map(key, again))

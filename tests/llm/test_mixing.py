from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidyledger.llm import mixing


def water_filling(sizes: dict, weights: dict, share: float = 1.5, passes: int = 2) -> dict:
    """Targets by giving the excess of full sources to the others, again and again."""
    left, full = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in sizes if s not in full]
        total = sum(weights[s] for s in open_)
        now = {s: left * weights[s] / total for s in open_} if total else {}
        over = [s for s in open_ if now[s] > passes * sizes[s]]
        if not over:
            return {**now, **full}
        for s in over:
            full[s] = passes * sizes[s]
            left -= full[s]


def _mixed(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(5)
    return mixing.mix_sources(df)


@pytest.mark.parametrize("hot", [1, 40])
def test_targets_and_taken(spark, hot):
    rows = [(i, None if i % 7 == 6 else f"s{i % 7}", (i * 37) % 101 * (hot if i % 7 == 0 else 1)) for i in range(700)]
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size
    names = sorted(s for s in sizes if s is not None) + [None]
    wanted = water_filling(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)})
    found = _mixed(spark, rows).collect()
    taken = defaultdict(int)
    for r in found:
        assert r.target == pytest.approx(wanted[r.source])
        assert r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source in sizes:
        assert abs(taken[source] - wanted[source]) <= 2
    again = {r.doc_id: r.taken for r in _mixed(spark, rows).collect()}
    assert again == {r.doc_id: r.taken for r in found}


def test_one_source_and_no_words(spark):
    assert {r.taken for r in _mixed(spark, [(1, "a", 10), (2, "a", 10)]).collect()} == {10, 20}
    assert [r.taken for r in _mixed(spark, [(1, "a", 0), (2, None, 0)]).collect()] == [0, 0]


def test_rows_of_the_mix(spark):
    rows = [(1, " a  b\tc ", "x"), (2, "d e f", "x"), (3, None, "y"), (4, "g", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix_sources(df)
    copies = mixing.mixed_rows(mixed, df.columns)
    assert copies.columns == df.columns
    words = copies.select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert words == mixed.agg(F.sum("taken")).first()[0]
    for r in copies.collect():
        whole = next(t for d, t, _ in rows if d == r.doc_id)
        assert whole.startswith(r.text)

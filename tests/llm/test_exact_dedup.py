from __future__ import annotations

import hashlib
from collections import defaultdict

from tidyledger.llm import exact_dedup
from tidyledger.llm.common import checkpointed


def _expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text].append(doc_id)
    return {
        (d, max(ids), len(ids), d == max(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items()
        for d in ids
    }


def test_frequent_and_rare_texts(spark):
    """A third of the rows has one text; it leaves on the map side, with the same result."""
    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 4}" if i % 3 == 1 else f"own {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = exact_dedup.exact_dedup(df)
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect()}
    assert got == _expected(rows)


def test_result_does_not_depend_on_the_summary(spark):
    rows = [(i, f"t{i % 50}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    digests = checkpointed(df.select("doc_id", exact_dedup.text_digest().alias("text_sha256")))
    winners = exact_dedup.heavy_winners(digests, "doc_id", "text_sha256", heavy=5, tracked=8)
    assert winners.count() <= 5
    got = {tuple(r) for r in exact_dedup.mark_copies(digests, winners).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()}
    assert got == _expected(rows)


def test_repeats_of_a_frequent_winner(spark):
    """Of rows that repeat the id that stays, one is kept."""
    rows = [(7, "same")] * 200 + [(i, "same") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = exact_dedup.exact_dedup(df).collect()
    assert len(found) == 205
    assert [r.doc_id for r in found if r.kept] == [7]
    assert {r.group_size for r in found} == {205}


def test_no_python_on_the_way(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = exact_dedup.exact_dedup(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

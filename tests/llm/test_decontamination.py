from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidyledger.llm import decontamination
from tidyledger.llm.decontamination import Search, compiled

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n_words string, items string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda c: c.group().lower(), text or ""))


def brute(text, items, window=10):
    """Words, hit positions and items of a text, by looking at every place."""
    w, hit, found = words(text), set(), set()
    for item, item_text in items:
        v = words(item_text)
        m = min(len(v), window)
        strings = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)} if m else set()
        for i in range(len(w) - m + 1 if m else 0):
            if tuple(w[i : i + m]) in strings:
                hit.update(range(i, i + m))
                found.add(item)
    return len(w), hit, sorted(str(i) for i in found if i is not None)


def check(spark, docs, items, window=10):
    df = spark.createDataFrame([(i, t, "x", None) for i, t in docs], DOCS).repartition(2)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.decontaminate(df, benchmark, window=window).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans]) for r in found)
    wanted = []
    for i, text in docs:
        n, hit, listed = brute(text, items, window)
        begins = sorted(p for p in hit if p - 1 not in hit)
        ends = sorted(p + 1 for p in hit if p + 1 not in hit)
        wanted.append((i is None, i or 0, n, len(hit), listed, list(zip(begins, ends))))
    assert got == sorted(wanted)


def prose(draw, n, vocabulary=30):
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def messy():
    draw = random.Random(5)
    items = [(i, prose(draw, draw.choice([1, 3, 9, 10, 11, 25, 60]), 400)) for i in range(30)]
    items += [(100, "Été, l'OISEAU-lyre!"), (101, ""), (102, None), (103, " ,. "), (None, prose(draw, 15, 400))]
    items += [(104, items[5][1]), (5, prose(draw, 12, 400)), (105, "a a a a a a a a a a a a")]
    docs = [(i, prose(draw, 200, 400)) for i in range(20)]
    for i, (_, text) in enumerate(items):
        around = prose(draw, draw.randrange(40)), prose(draw, draw.randrange(40))
        docs.append((50 + i, f"{around[0]} {(text or '').upper()}\n{around[1]}"))
    docs += [(200, None), (201, ""), (202, "--"), (None, items[3][1]), (None, None), (203, items[7][1]), (203, items[7][1])]
    docs += [(204, prose(draw, 30_000, 400) + " " + items[8][1]), (205, "A " * 500), (206, "x" * 100_000)]
    return docs, items


def test_against_brute_force(spark):
    check(spark, *messy())


def test_items_of_several_files_and_other_windows(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 300)
    check(spark, *messy())
    check(spark, *messy(), window=4)


def test_without_items_or_documents(spark):
    docs, items = messy()
    check(spark, docs, [])
    check(spark, docs, [(1, None), (2, " ")])
    check(spark, [], items)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-1, 3), max_size=60), st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=8), min_size=1, max_size=6))
def test_occurrences(text, strings):
    """Few different words: many shifts of zero and one, overlaps and words that no item has."""
    tables = compiled([str(i) for i in range(len(strings))], pa.array([" ".join("abcd"[c] for c in s) for s in strings]), 5)
    search = Search(tables)
    code = {w.decode(): i for i, w in enumerate(search.vocabulary.to_pylist())}
    numbers = np.array([code.get("abcd"[c], -1) if c >= 0 else -1 for c in text], np.int32)
    for m in search.lengths:
        start, string = search.occurrences(numbers, m)
        assert len(set(start.tolist())) == len(start)
        held = {tuple(tables["numbers"][a : a + m].tolist()) for a in tables[f"at{m}"].tolist()}
        wanted = [i for i in range(len(numbers) - m + 1) if tuple(numbers[i : i + m].tolist()) in held]
        assert sorted(start.tolist()) == wanted


def test_skips_impossible_places(monkeypatch):
    """Of words that no item has, one in ten is looked at."""
    tables = compiled(["1"], pa.array([" ".join(f"w{i}" for i in range(40))]))
    looked = []
    real = decontamination._hash
    monkeypatch.setattr(decontamination, "_hash", lambda n, ends, m: looked.append(len(ends)) or real(n, ends, m))
    Search(tables).occurrences(np.full(10_000, -1, np.int32), 10)
    assert sum(looked) <= 1100


@pytest.mark.parametrize("text", ["one two", "one"])
def test_short_items_are_whole(spark, text):
    check(spark, [(1, "zero one two"), (2, "one"), (3, "two one"), (4, "onetwo")], [(1, text)])

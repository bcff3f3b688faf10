from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa

from tidyledger.llm import parsing
from tidyledger.llm.ngrams import code_points
from tests.llm.conftest import prose


def test_equal_substrings_share_interior_phrases():
    """Whatever stands before and after, almost all phrases of a passage are the same."""
    passage = prose(9, 600)
    found = []
    for around in (("", ""), (prose(10, 37), prose(11, 5)), ("x", "é" * 9)):
        names, owner = code_points(pa.array([around[0] + passage + around[1]]))
        names = parsing.mix(names.astype(np.uint64))
        for _ in range(3):
            names, owner = parsing.phrases(names, owner)
        found.append(set(names.tolist()))
    for other in found[1:]:
        assert len(found[0] & other) >= 0.9 * len(found[0]) - 4


def test_runs_and_tiny_texts():
    texts = ["", None, "a", "aa", "a" * 1000, "ab" * 500, "é", "😀😀"]
    found = parsing.sketch(pa.array(texts, pa.string()))
    assert not found[0].any() and not found[1].any()
    assert all(row.any() for row in found[2:])
    assert len({row.tobytes() for row in found[1:]}) == len(texts) - 1
    # A text alone and in company.
    for i, text in enumerate(texts):
        assert (parsing.sketch(pa.array([text], pa.string()))[0] == found[i]).all()


def test_likeness_follows_the_shared_part():
    base = prose(1, 3000)
    shares = [0.0, 0.25, 0.5, 0.75, 1.0]
    other = prose(2, 3000)
    mixed = [base[: int(len(base) * s)] + other[int(len(base) * s) :] for s in shares]
    prints = parsing.sketch(pa.array([base, *mixed]))
    near = parsing.likeness(np.repeat(prints[:1], len(shares), axis=0), prints[1:])
    assert near[0] < 0.05 and near[-1] == 1.0
    for share, value in zip(shares, near):
        assert abs(value - share / (2 - share)) < 0.2
    empty = parsing.sketch(pa.array(["", ""]))
    assert parsing.likeness(empty[:1], empty[1:]).tolist() == [1.0]


def test_query(spark, sample, corpus):
    from tidyledger.llm.queries import queries

    found = {r.doc_id: r for r in queries()["op5_parsing_fingerprints"](spark, sample).collect()}
    ids = sorted(corpus, reverse=True)
    prints: dict = {}
    for doc_id, following in zip(ids, ids[1:] + ids[:1]):
        r, text = found[doc_id], corpus[doc_id].text or ""
        changed = parsing.edited(text, corpus[following].text or "")
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        sketches = parsing.sketch(pa.array([text, changed, corpus[following].text]))
        assert r.fingerprint == sketches[0].astype(">u2").tobytes().hex()
        assert r.edited_fingerprint == sketches[1].astype(">u2").tobytes().hex()
        assert r.near_edited == parsing.likeness(sketches[:1], sketches[1:2])[0]
        assert r.near_next == parsing.likeness(sketches[:1], sketches[2:])[0]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint


def test_next_across_many_ranges(spark):
    """Every row finds its next, however the rows are split; the last one the first."""
    texts = {i: prose(i, random.Random(i).randint(0, 30)) for i in range(120)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(30)
    found = {r.doc_id: r.edited_sha256 for r in parsing.fingerprint_with_next(df).collect()}
    for i, text in texts.items():
        wanted = parsing.edited(text, texts[(i - 1) % 120])
        assert found[i] == hashlib.sha256(wanted.encode()).hexdigest()


def test_short_texts_that_keep_half_stay_alike():
    """Half a text of 30 to 150 characters is a third of both together, by small phrases too."""
    for length in (30, 60, 100, 150):
        texts = [prose(seed, 60)[:length] for seed in range(200)]
        others = [prose(1000 + seed, 60)[:length] for seed in range(200)]
        changed = [parsing.edited(a, b) for a, b in zip(texts, others)]
        prints, edited, apart = (parsing.sketch(pa.array(t)) for t in (texts, changed, others))
        near = parsing.likeness(prints, edited)
        assert near.min() > 0 and near.mean() > 0.25
        assert (near > parsing.likeness(prints, apart)).mean() > 0.9


def test_whole_text_is_named_once():
    found = parsing.sketch(pa.array(["a", "é", "a" * 1000]))
    assert (found > 0).sum(axis=1).tolist() == [1, 1, 1]


def test_no_single_task_takes_the_texts_between_ranges(spark):
    """What goes to one partition has no text."""
    df = spark.createDataFrame([(i, prose(i, 9)) for i in range(40)], "doc_id long, text string")
    plan = parsing.fingerprint_with_next(df)._jdf.queryExecution()
    said = spark._jvm.PythonSQLUtils.explainString(plan, "formatted")
    single = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: SinglePartition", said)
    assert single and all("_place" in columns and "_end" not in columns for columns in single)


_WORD = 2**64
_FIXED = [int(x) for x in (parsing._A, parsing._B, parsing._C)]


def _brute_mix(x: int) -> int:
    a, b, c = _FIXED
    x = (x + c) % _WORD
    x = (x ^ (x >> 30)) * a % _WORD
    x = (x ^ (x >> 27)) * b % _WORD
    return x ^ (x >> 31)


def _brute_phrases(names: list[int]) -> list[int]:
    """One level over one text, symbol by symbol."""
    a, b, _ = _FIXED
    runs = [(name, len(list(same))) for name, same in itertools.groupby(names)]
    symbols = [name if n == 1 else _brute_mix((name + n) % _WORD) for name, n in runs]
    labels = symbols
    for _ in range(4):
        tossed = []
        for i, label in enumerate(labels):
            before = labels[i - 1] if i else label ^ (_WORD - 1)
            bit = next(k for k in range(64) if (label >> k) % 2 != (before >> k) % 2)
            tossed.append(2 * bit + (label >> bit) % 2)
        labels = tossed
    found, phrase = [], []
    for i, symbol in enumerate(symbols):
        inner = 0 < i < len(symbols) - 1
        if inner and labels[i - 1] < labels[i] > labels[i + 1]:
            found.append(phrase)
            phrase = []
        phrase.append(symbol)
    found.append(phrase)
    return [_brute_mix((sum(s * pow(a, k, _WORD) for k, s in enumerate(p)) + len(p) * b) % _WORD) for p in found]


def _brute_sketch(text: str) -> list[int]:
    names, by_level = [_brute_mix(ord(c)) for c in text], {}
    for level in range(1, 7):
        if names:
            names = _brute_phrases(names)
            by_level[level] = [_brute_mix((name + level) % _WORD) for name in names]
            if len(names) == 1:
                names = []
    sketch = []
    for i in range(64):
        for levels in ((3, 4, 5, 6), (2,), (1,)):
            drawn = [d for level in levels for d in by_level.get(level, []) if d >> 58 == i]
            if drawn:
                break
        sketch.append(_brute_mix(min(drawn)) % 65535 + 1 if drawn else 0)
    return sketch


def test_sketch_against_plain_python():
    draw = random.Random(3)
    texts = [prose(i, draw.choice([1, 2, 5, 40, 300])) for i in range(60)]
    texts += ["", "a", "aa", "ab" * 40, "a" * 500, "aab" * 90, "é😀" * 30, "\n\n \t", "日本語" * 7 + "x"]
    texts += ["".join(draw.choice("ab") for _ in range(draw.randrange(200))) for _ in range(40)]
    found = parsing.sketch(pa.array(texts))
    for text, row in zip(texts, found.tolist()):
        assert row == _brute_sketch(text)


def test_query_against_plain_python(spark, sample, corpus):
    """Fingerprints and likeness of the query on some documents, all parts in plain Python."""
    from tidyledger.llm.queries import queries

    found = {r.doc_id: r for r in queries()["op5_parsing_fingerprints"](spark, sample).collect()}
    ids = sorted(corpus, reverse=True)
    pairs = sorted(zip(ids, ids[1:] + ids[:1]), key=lambda p: len(corpus[p[0]].text or ""))
    for doc_id, following in pairs[:60]:
        text, after = corpus[doc_id].text or "", (corpus[following].text or "")[:4000]
        half = len(text) // 2
        own, changed = _brute_sketch(text), _brute_sketch(text[: len(text) - half] + after[:half])
        assert found[doc_id].fingerprint == "".join(f"{n:04x}" for n in own)
        assert found[doc_id].edited_fingerprint == "".join(f"{n:04x}" for n in changed)
        either = sum(1 for x, y in zip(own, changed) if x or y)
        same = sum(1 for x, y in zip(own, changed) if x == y and x)
        assert found[doc_id].near_edited == (same / either if either else 1.0)

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tidyledger.llm.packing import Encoder, Packer

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_are_those_of_the_file():
    draw = random.Random(1)
    alphabet = list(" \n\t.,'ab s t é  　\x85\x1c😀1Z") + [" the", "'s", "<|endoftext|>"]
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60))) for _ in range(3000)] + ["", None]
    encoder, tokenizer = Encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    texts += [f"a{chr(c)} b{chr(c)}{chr(c)} {chr(c)}1" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts += [c * 20_000 for c in "x \n"]
    flat, first = encoder.encode(pa.array(texts, pa.string()))
    wanted = tokenizer.encode_batch([text or "" for text in texts], add_special_tokens=False)
    for i, found in enumerate(wanted):
        assert flat[first[i] : first[i + 1]].tolist() == found.ids


def _check(lengths: list[int], packer: Packer) -> list[int]:
    documents = [np.arange(n, dtype="<u4") + 7 * i for i, n in enumerate(lengths)]
    closed = [w for i, ids in enumerate(documents) for w in packer.put(i, ids)] + packer.finish()
    fills, seen = [], {i: [] for i in range(len(lengths))}
    for window in closed:
        fills.append(sum(len(ids) for _, _, ids in window))
        for i, start, ids in window:
            assert (ids == documents[i][start : start + len(ids)]).all() and len(ids)
            seen[i].append((start, len(ids)))
    for i, n in enumerate(lengths):
        at = 0
        for start, length in sorted(seen[i]):
            assert start == at
            at += length
        assert at == n
    return fills


def test_no_id_is_lost_and_nothing_is_padded():
    draw = random.Random(4)
    for capacity, limit in ((16, 5), (64, 1000), (2048, 30)):
        lengths = [draw.randint(1, 3 * capacity) for _ in range(500)]
        fills = _check(lengths, Packer(capacity, limit))
        assert max(fills) <= capacity
        assert all(f & (f - 1) == 0 for f in fills)
        assert sum(f < capacity for f in fills) <= capacity.bit_length()
    assert _check([], Packer()) == []
    # Documents of which no two fit in a window.
    assert sum(_check([1100] * 300, Packer(2048, 50))) == 330_000


def test_sum_of_squares_rule():
    """The level with the least sum of squared counts, of equal ones the fullest."""
    draw = random.Random(6)
    packer = Packer(20, 10**6)
    for i in range(2000):
        size = draw.randint(1, 20)
        before = packer.levels.copy()
        if size < 20:
            best = None
            for level in range(20 - size, -1, -1):
                if level and not before[level]:
                    continue
                after = before.copy()
                after[level] -= level > 0
                after[level + size] += level + size < 20
                squares = int((after[1:20] ** 2).sum())
                if best is None or squares < best[0]:
                    best = squares, level
            assert packer._level(size) == best[1]
        packer.put(i, np.zeros(size, "<u4"))


def test_query(spark, sample, corpus):
    from tidyledger.llm.queries import queries

    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = queries()["op6_packing"](spark, sample).collect()
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(corpus)
    for doc_id, pieces in by_doc.items():
        ids = np.array(tokenizer.encode(corpus[doc_id].text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)

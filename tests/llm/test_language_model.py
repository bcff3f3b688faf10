from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from tidyledger.llm import language_model


def _tokens(text):
    lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["</s>"]


class Brute:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.pairs, self.words = Counter(), Counter()
        for text in texts:
            last = "<s>"
            for word in _tokens(text):
                self.pairs[last, word] += 1
                self.words[word] += 1
                last = word
        self.followers, self.total, self.before = defaultdict(list), Counter(), Counter()
        for (a, b), n in self.pairs.items():
            self.followers[a].append(n)
            self.total[a] += n
            self.before[b] += 1
        self.d = language_model.discounts([sum(n == k for n in self.pairs.values()) for k in (1, 2, 3, 4)])
        self.e = language_model.discounts([sum(n == k for n in self.before.values()) for k in (1, 2, 3, 4)])
        self.lost = sum(self.e[min(k, 3) - 1] for k in self.before.values())
        self.freed = {a: sum(self.d[min(k, 3) - 1] for k in found) for a, found in self.followers.items()}

    def chance(self, a, b):
        n, found = self.before[b], len(self.pairs)
        lower = (max(n - self.e[min(n, 3) - 1], 0) if n else 0) / found + self.lost / found / (len(self.words) + 1)
        if not self.total[a]:
            return lower
        n = self.pairs[a, b]
        return (max(n - self.d[min(n, 3) - 1], 0) if n else 0) / self.total[a] + self.freed[a] / self.total[a] * lower

    def score(self, text):
        total, last = 0.0, "<s>"
        for word in _tokens(text):
            total += math.log10(self.chance(last, word))
            last = word
        return total


def test_against_dictionaries(spark, sample, corpus):
    from tidyledger.llm.queries import queries

    brute = Brute([r.text for d, r in corpus.items() if crc32(str(d).encode()) % 7 != 2])
    n, v = sum(brute.words.values()), len(brute.words)
    found = queries()["op2_language_model"](spark, sample).collect()
    assert len(found) == len(corpus)
    held_model = held_base = 0.0
    for r in found:
        tokens = _tokens(corpus[r.doc_id].text)
        base = sum(math.log10((brute.words[t] + 1) / (n + v + 1)) for t in tokens)
        assert (r.n_tokens, r.train_tokens) == (len(tokens), n)
        assert r.n_known == sum(brute.words[t] > 0 for t in tokens)
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 7 == 2)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(brute.score(corpus[r.doc_id].text), rel=1e-6)
        if r.held_out:
            held_model, held_base = held_model + r.score, held_base + r.base_score
    assert held_model > held_base


class Orders:
    """A model of any order with dictionaries: longest n-grams counted, shorter ones by what stands before them."""

    def __init__(self, texts, order):
        self.order, self.counts = order, {order: Counter()}
        for text in texts:
            words = ["<s>"] * (order - 1) + _tokens(text)
            for i in range(order - 1, len(words)):
                self.counts[order][tuple(words[i - order + 1 : i + 1])] += 1
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(gram[1:] for gram in self.counts[k + 1])
        self.discounts = {
            k: language_model.discounts([sum(n == j for n in c.values()) for j in (1, 2, 3, 4)]) for k, c in self.counts.items()
        }
        self.total, self.freed = defaultdict(Counter), defaultdict(Counter)
        for k, c in self.counts.items():
            for gram, n in c.items():
                self.total[k][gram[:-1]] += n
                self.freed[k][gram[:-1]] += self.discounts[k][min(n, 3) - 1]

    def chance(self, gram):
        k = len(gram)
        if not k:
            return 1 / (len(self.counts[1]) + 1)
        total = self.total[k][gram[:-1]]
        if not total:
            return self.chance(gram[1:])
        n = self.counts[k][gram]
        kept = max(n - self.discounts[k][min(n, 3) - 1], 0) if n else 0
        return kept / total + self.freed[k][gram[:-1]] / total * self.chance(gram[1:])

    def score(self, text):
        words = ["<s>"] * (self.order - 1) + _tokens(text)
        grams = [tuple(words[i - self.order + 1 : i + 1]) for i in range(self.order - 1, len(words))]
        return sum(math.log10(self.chance(gram)) for gram in grams)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_distinct_rows(order):
    draw = np.random.default_rng(order)
    columns = [draw.integers(0, 5, 400) for _ in range(order)]
    rows = list(zip(*[c.tolist() for c in columns]))
    found, times = language_model._counted(columns, 5)
    assert list(zip(*[c.tolist() for c in found])) == sorted(set(rows))
    assert dict(zip(sorted(set(rows)), times.tolist())) == Counter(rows)
    at, which = language_model._distinct(columns, 5)
    assert len(at) == len(set(rows)) and [rows[at[k]] for k in which.tolist()] == rows


@pytest.mark.parametrize("order", [2, 3, 4])
def test_orders_against_dictionaries(spark, corpus, monkeypatch, order):
    """Several buckets and steps, frequent words that are spread, texts that are not in the model."""
    monkeypatch.setattr(language_model, "STEP", 20_000)
    monkeypatch.setattr(language_model, "BUCKET_CHARS", 8_000)
    texts = {d: (r.text or "")[:3000] for d, r in sorted(corpus.items())[:120]}
    texts |= {1000: "", 1001: None, 1002: "a", 1003: "never seen the of the", 1004: "the the the the the"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    model = language_model.train(df.filter("doc_id % 5 <> 0"), order=order)
    brute = Orders([t for d, t in texts.items() if d % 5], order)
    words = Counter(w for d, t in texts.items() if d % 5 for w in _tokens(t))
    assert (model.train_tokens, model.types, len(model.frequent) > 3) == (sum(words.values()), len(words), True)
    found = language_model.score(df, model).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r.score == pytest.approx(brute.score(texts[r.doc_id]), rel=1e-6)
        tokens = _tokens(texts[r.doc_id])
        assert (r.n_tokens, r.n_known) == (len(tokens), sum(words[t] > 0 for t in tokens))
        base = sum(math.log10((words[t] + 1) / (sum(words.values()) + len(words) + 1)) for t in tokens)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    model.remove()


def test_longer_contexts_say_more(spark, corpus):
    """Of texts that repeat, an order more gives a greater probability."""
    df = spark.createDataFrame([(i, "a b c d e a c b d e b a d c e " * 20) for i in range(9)], "doc_id long, text string")
    scores = [language_model.score(df, language_model.train(df, order=k)).first().score for k in (2, 3, 4)]
    assert scores[0] < scores[1] < scores[2] < 0


def test_chances_sum_to_one(spark):
    brute = Brute(["a b a c", "b b d", "a", ""])
    for context in ("a", "b", "<s>", "unseen"):
        known = sum(brute.chance(context, w) for w in brute.words)
        assert known + brute.chance(context, "never seen") == pytest.approx(1)


def test_frequent_words_are_spread_without_effect():
    draw = np.random.default_rng(0)
    first, second = draw.integers(0, 9, 1000).astype(np.uint64), draw.integers(0, 99, 1000).astype(np.uint64)
    spread = language_model._bucket([first, second], np.array([3], np.uint64), 8)
    assert len(set(spread[first == 3])) == 8
    for word in (1, 2, 4):
        assert len(set(spread[first == word])) == 1
    assert (spread == language_model._bucket([first, second], np.array([3], np.uint64), 8)).all()
    third = draw.integers(0, 99, 1000).astype(np.uint64)
    both = language_model._bucket([first % np.uint64(5), first, third], np.array([3, 8], np.uint64), 8)
    assert len(set(both[(first == 3)])) == 8 == len(set(both[first == 8]))
    assert len(set(both[first == 4])) == 1


@pytest.mark.parametrize("most, width", [(255, 1), (256, 2), (2**16, 4), (2**32, 8), (2**40, 8)])
def test_counts_of_any_size_are_stored_whole(tmp_path, most, width):
    """Pairs that occur more often than 32 bits can say, through files and maps."""
    folder = tmp_path.as_uri()
    first, second = np.array([5, 5, 9, 9], np.uint64), np.array([1, 2, 1, 2], np.uint64)
    (first, second), (times,) = language_model._summed(
        [np.tile(first, 2), np.tile(second, 2)], [np.array([1, 0, 3, most // 2, 0, 2, 0, most - most // 2], np.int64)]
    )
    keys = language_model.gram_key([first, second])
    order = np.argsort(keys)
    model = language_model.Model(folder, 2, 1, np.zeros(0, np.uint64), 0, 0, 0, {2: [0, 0, 0]}, [0, 0, 0], [0, 0, 0])
    assert language_model.narrow(times).itemsize == width
    language_model._store(folder, "keys2-0", keys[order])
    language_model._store(folder, "counts2-0", language_model.narrow(times[order]))
    words = np.zeros(2, language_model.WORD)
    words["count"], words["more"], words["before"] = [4, most], 2**33, 2**40
    hashes = np.sort(np.array([5, 9], np.uint64))
    language_model._store(folder, "hashes-0", hashes)
    language_model._store(folder, "words-0", words)
    scorer = language_model.Scorer(model)
    asked = np.array([9, 5, 9, 5, 7], np.uint64), np.array([2, 1, 1, 2, 1], np.uint64)
    assert scorer.gram_counts(list(asked)).tolist() == [most, 1, 3, 2, 0]
    found = scorer.word_rows(np.array([9, 7, 5], np.uint64))
    assert found["count"].tolist() == [most, 0, 4] and found["more"].tolist() == [2**33, 0, 2**33]
    model.remove()
    assert not tmp_path.exists()


def test_a_task_maps_what_it_needs(tmp_path, monkeypatch):
    """Of many buckets those of the lookups only, and never more than the limit at once."""
    folder, buckets = tmp_path.as_uri(), 500
    draw = np.random.default_rng(4)
    first, second = draw.integers(1, 2**60, 4000).astype(np.uint64), draw.integers(1, 2**60, 4000).astype(np.uint64)
    bucket = language_model._bucket([first, second], np.zeros(0, np.uint64), buckets)
    for b in range(buckets):
        keys = np.sort(language_model.gram_key([first[bucket == b], second[bucket == b]]))
        language_model._store(folder, f"keys2-{b}", keys)
        language_model._store(folder, f"counts2-{b}", language_model.narrow((keys % np.uint64(1000)).astype(np.int64)))
    model = language_model.Model(folder, 2, buckets, np.zeros(0, np.uint64), 0, 0, 0, {2: [0, 0, 0]}, [0, 0, 0], [0, 0, 0])
    scorer = language_model.Scorer(model)
    wanted = (language_model.gram_key([first, second]) % np.uint64(1000)).astype(np.int64)
    assert scorer.gram_counts([first[:5], second[:5]]).tolist() == wanted[:5].tolist()
    assert len(scorer.maps) == 2 * len(set(bucket[:5].tolist()))
    monkeypatch.setattr(language_model, "MAPS", 7)
    assert scorer.gram_counts([first, second]).tolist() == wanted.tolist()
    assert len(scorer.maps) <= 7


def test_the_limit_of_spreading_follows_the_buckets(spark):
    """A word that is spread has at least a quarter of a bucket's share, however many buckets there are."""
    text = " ".join(["the"] * 10 + ["of"] * 3 + [f"w{i}" for i in range(87)])
    rows = spark.createDataFrame([(i, text) for i in range(200)], "_id long, _text string")
    for buckets, number in ((2, 0), (4, 1), (10, 2), (100, 91)):  # with start and end, 1 in 102 tokens each
        assert len(language_model._frequent_words(rows, 200, buckets)) == number


def test_model_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = language_model.score(df, language_model.train(df.filter("false"))).collect()
    assert {(r.n_tokens, r.n_known, r.base_score, r.score) for r in found} == {(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)}

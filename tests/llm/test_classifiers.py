from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa

from tests.llm.conftest import prose
from tidyledger.llm import language, quality
from tidyledger.llm.ngrams import code_points, hashed_ngrams


def test_ngrams_stay_within_their_text():
    points, owner = code_points(pa.array(["aé", None, "", "b"]))
    assert points.tolist() == [97, 233, 98] and owner.tolist() == [0, 0, 3]
    counts = hashed_ngrams(points, owner, 4, range(1, 4), 64)
    assert counts.sum(axis=1).tolist() == [3, 0, 0, 1]


def test_votes_against_brute_force():
    draw = np.random.default_rng(0)
    texts = [prose(i, 40) if i % 2 else prose(i, 40).upper() + "!!" for i in range(60)]
    found = quality.measures(pa.array(texts))
    idf = np.ones(quality.SIZE, np.float32)
    rows = quality.weighted(found, idf)
    topics = quality._leading_directions(rows, 8)
    vectors = quality._unit(rows @ topics).astype(np.float32)
    labels = draw.integers(0, 2, 60).astype(np.float32)
    model = quality.QualityModel(idf, topics, vectors, labels, 0.5)
    got = model.scores(pa.array([*texts, "", None]), neighbours=7)
    for i in range(60):
        cosines = vectors @ vectors[i]
        near = np.argsort(-cosines)[:7]
        weight = np.maximum(cosines[near], 0) ** quality.SHARPNESS + 1e-9
        assert abs(got[i] - (weight * labels[near]).sum() / weight.sum()) < 1e-3
    assert got[60:].tolist() == [0.5, 0.5]


def test_as_many_neighbours_vote_among_100_and_10000_voters():
    """The nearest 25, whose labels alone decide."""
    draw = np.random.default_rng(5)
    texts = pa.array([prose(i, 60) for i in range(8)])
    found = quality.measures(texts)
    idf, topics = np.ones(quality.SIZE, np.float32), np.eye(quality.SIZE, 64, dtype=np.float32)
    asked = quality._unit(quality.weighted(found, idf) @ topics)
    for voters in (100, 10_000):
        vectors = quality._unit(draw.standard_normal((voters, 64)).astype(np.float32) + asked[draw.integers(0, 8, voters)] * 4)
        order = np.argsort(-(asked @ vectors.T), axis=1)
        for i in range(8):
            labels = np.zeros(voters, np.float32)
            labels[order[i, :25]] = 1
            assert quality.QualityModel(idf, topics, vectors, labels, 0.5).scores(texts)[i] == 1
            labels[order[i, 24]] = 0
            assert quality.QualityModel(idf, topics, vectors, labels, 0.5).scores(texts)[i] < 1


def test_quality_of_held_out_documents(spark, sample):
    from tidyledger.llm.queries import queries

    found = {r.doc_id: r for r in queries()["op7_quality"](spark, sample).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sample}/labels.parquet").collect()}
    for doc_id, r in found.items():
        assert r.held_out == (crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    apart = [(found[d].predicted, label) for d, label in labels.items() if found[d].held_out]
    assert len(apart) > 10
    assert sum(p == label for p, label in apart) >= 0.9 * len(apart)


def test_languages_of_held_out_documents(spark, sample, corpus):
    from tidyledger.llm.queries import queries

    found = queries()["op9_language"](spark, sample).collect()
    assert len(found) == len(corpus)
    apart = [r for r in found if r.held_out]
    for r in found:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1)
    assert sum(r.lang_pred == corpus[r.doc_id].lang for r in apart) >= 0.95 * len(apart)


def test_ftrl_against_one_coordinate_after_the_other():
    """The update of McMahan et al., in plain loops over rows, features and classes."""
    draw = np.random.default_rng(6)
    x, y = np.round(draw.random((30, 5)) * (draw.random((30, 5)) < 0.6), 2), draw.integers(0, 3, 30)
    alpha, beta, l1, l2 = 0.7, 1.3, 0.4, 0.2
    model = language.Ftrl(3, 5, alpha, beta, l1, l2)
    z, n = [[0.0] * 3 for _ in range(5)], [[0.0] * 3 for _ in range(5)]

    def weight(i, k):
        if abs(z[i][k]) <= l1:
            return 0.0
        sign = 1 if z[i][k] > 0 else -1
        return -(z[i][k] - sign * l1) / ((beta + n[i][k] ** 0.5) / alpha + l2)

    for at in range(0, 30, 6):
        model.learn(x[at : at + 6], y[at : at + 6])
        w = [[weight(i, k) for k in range(3)] for i in range(5)]
        gradient = [[0.0] * 3 for _ in range(5)]
        for row, label in zip(x[at : at + 6], y[at : at + 6]):
            powers = [np.exp(sum(row[i] * w[i][k] for i in range(5))) for k in range(3)]
            for i in range(5):
                for k in range(3):
                    gradient[i][k] += (powers[k] / sum(powers) - (k == label)) * row[i]
        for i in range(5):
            for k in range(3):
                sigma = ((n[i][k] + gradient[i][k] ** 2) ** 0.5 - n[i][k] ** 0.5) / alpha
                z[i][k] += gradient[i][k] - sigma * w[i][k]
                n[i][k] += gradient[i][k] ** 2
    wanted = np.array([[weight(i, k) for k in range(3)] for i in range(5)])
    assert np.abs(model.weights() - wanted).max() < 1e-9
    assert (wanted == 0).any() and (wanted != 0).any()


def test_the_language_model_is_sparse_and_its_temperature_inside_the_range(spark, sample):
    """With the settings of the query."""
    from tidyledger.llm.queries import documents
    from tidyledger.llm.ngrams import remainder

    docs = documents(spark, sample).filter(remainder("doc_id", 3) != 1)
    model = language.fit(docs)
    assert (model.weights == 0).mean() > 0.85
    assert 0.1 < model.temperature < 10
    texts = pa.array([r.text or "" for r in docs.limit(50).collect()])
    found = model.probabilities(texts)
    assert np.abs(found.sum(axis=1) - 1).max() < 1e-5 and found.max() < 1


def test_temperature_of_rows_that_are_told_apart_and_of_none():
    y = np.arange(40) % 2
    apart = np.where(np.arange(2)[None, :] == y[:, None], 1.0, -1.0)
    t = language.fit_temperature(apart, y)
    chance = language.softmax(apart / t)[np.arange(40), y]
    assert np.allclose(chance, 41 / 42, atol=1e-6)  # the smoothed label
    assert np.allclose(language.fit_temperature(apart * 5, y), 5 * t)
    assert language.fit_temperature(np.zeros((4, 2)), np.zeros(4, int)) == 1.0
    assert language.fit_temperature(np.zeros((0, 2)), np.zeros(0, int)) == 1.0
    assert language.fit_temperature(np.zeros((3, 1)), np.zeros(3, int)) == 1.0
    assert language.fit_temperature(apart, 1 - y) == 1000  # worse than chance


def test_ftrl_is_sparse_and_the_temperature_calibrates():
    draw = np.random.default_rng(1)
    y = draw.integers(0, 3, 600)
    x = draw.normal(size=(600, 50)) * 0.1
    x[np.arange(600), y] += 0.5
    model = language.Ftrl(3, 50, l1=2.0)
    for at in range(0, 600, 50):
        model.learn(x[at : at + 50], y[at : at + 50])
    weights = model.weights()
    assert (weights == 0).mean() > 0.5
    logits = x @ weights
    assert (logits.argmax(axis=1) == y).mean() > 0.9
    smooth = np.full((600, 3), 1 / 602 / 2)
    smooth[np.arange(600), y] = 601 / 602
    loss = lambda t: -(smooth * np.log(language.softmax(logits / t))).sum(axis=1).mean()
    best = language.fit_temperature(logits, y)
    assert loss(best) <= min(loss(1.0), loss(0.5), loss(3.0)) + 1e-6

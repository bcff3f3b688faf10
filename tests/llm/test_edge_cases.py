"""Every operator on messy rows and on an empty table, with the results it defines."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import messy_rows
from tests.llm.test_language_model import Brute, _tokens
from tests.llm.test_parsing import _brute_sketch
from tests.llm.test_token_counts import one
from tidyledger.llm import (
    decontamination,
    exact_dedup,
    language,
    language_model,
    mixing,
    packing,
    parsing,
    quality,
    secrets,
    simhash,
    token_counts,
)
from tidyledger.llm.common import quoted

ROWS = len(messy_rows())


def _labels(df):
    return df.select("doc_id", (F.col("doc_id") % 2).alias("quality")).unionByName(
        df.limit(1).select("doc_id", F.lit(None).cast("long").alias("quality"))
    )


OPERATORS = {
    "mix": mixing.mix_sources,
    "language_model": lambda df: language_model.score(df, language_model.train(df)),
    "exact_dedup": exact_dedup.exact_dedup,
    "simhash": simhash.simhash_near_duplicates,
    "parsing": parsing.fingerprint_with_next,
    "quality": lambda df: quality.score(df, quality.fit(df, _labels(df))),
    "secrets": lambda df: secrets.findings_of_paths(df, secrets.scan_versions(df)),
    "language": lambda df: language.predict(df, language.fit(df)),
    "token_counts": token_counts.token_counts,
    "decontamination": lambda df: decontamination.decontaminate(df, df, item_column="doc_id"),
}

# What operators that return their input's columns replace or leave out of them.
REPLACED = {
    "mix": ["size", "source_size", "weight", "target", "before", "taken_by_pass", "taken"],
    "exact_dedup": ["text_sha256", "keep_id", "group_size", "kept"],
    "quality": ["score", "predicted"],
    "secrets": ["digest", "findings", "text"],
}


@pytest.mark.parametrize("name", REPLACED)
def test_other_columns_come_back_whole(messy, name):
    """Under their own names, with their own values, whatever the operator calls its columns."""
    found = OPERATORS[name](messy)
    kept = [c for c in messy.columns if c.lower() not in REPLACED[name]]
    assert [c.lower() for c in found.columns if c in kept] == [c.lower() for c in kept]
    assert not [c for c in found.columns if c.startswith("_in") and c not in messy.columns]
    columns = [quoted(c) for c in kept]
    assert Counter(found.select(*columns).collect()) == Counter(messy.select(*columns).collect())
    new = [c for c in found.columns if c not in kept]
    assert sorted(new) == sorted(c for c in REPLACED[name] if c != "text")


@pytest.mark.parametrize("name", OPERATORS)
def test_row_for_row(spark, messy, empty, name):
    """One row for each row, repeated ones too; none for none, with the same schema."""
    full, none = OPERATORS[name](messy), OPERATORS[name](empty)
    assert full.count() == ROWS
    assert none.count() == 0
    assert full.dtypes == none.dtypes


def test_pack(messy, empty):
    found = packing.pack(messy).collect()
    assert packing.pack(empty).count() == 0
    by_sequence: dict = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 2048 and end & (end - 1) == 0
    assert sum(r.start == 0 for r in found) == ROWS
    empty_text = [r for r in found if r.doc_id == 5]
    assert [(r.length, r.doc_tokens) for r in empty_text] == [(1, 1)]


def test_exact_dedup_keeps_one_of_each_text(messy):
    found = exact_dedup.exact_dedup(messy).collect()
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text or "" for r in found}) == len({r.text_sha256 for r in found})
    by_text = {r.text or "": r for r in kept}
    assert by_text[""].doc_id == 5 and by_text[""].group_size == 3  # null ids come last
    assert sum(r.kept for r in found if r.doc_id == 11) == 2


def test_simhash_groups(messy):
    found = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.simhash_near_duplicates(messy).collect()}
    zero = "0" * 16
    assert {found[(4, zero)], found[(5, zero)], found[(6, zero)], found[(None, zero)]} == {4}
    assert {c for (d, _), c in found.items() if d in (1, 2, 3)} == {1}


def test_mix_takes_no_more_than_two_passes(messy):
    for r in mixing.mix_sources(messy).collect():
        assert 0 <= r.taken <= 2 * r.size
    taken = mixing.mix_sources(messy).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")
    )
    for r in taken.collect():
        assert abs(r.taken - r.target) <= 2


def test_undetermined_language(messy):
    model = language.fit(messy)
    found = {r.doc_id: r for r in language.predict(messy, model).collect()}
    for doc_id in (4, 5, 6):
        assert (found[doc_id].lang_pred, found[doc_id].score) == ("und", 0.0)
    assert found[1].lang_pred in ("en", "fr")


def test_spans(messy):
    ledger = secrets.scan_versions(messy)
    found = secrets.findings_of_paths(messy, ledger).filter("doc_id = 12")
    spans = found.select(secrets.listed_spans(F.col("findings"))).first()[0]
    assert spans == "assign:0:20,access:32:52,hex:53:77"


def by_row(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_scores_of_the_language_model(messy):
    texts = [r.text for r in messy.select("text").collect()]
    brute = Brute(texts)
    found = language_model.score(messy, language_model.train(messy)).collect()
    known = {}
    for doc_id, text, *_ in messy_rows():
        known.setdefault(doc_id, []).append((len(_tokens(text)), brute.score(text)))
    for r in found:
        assert any(n == r.n_tokens and r.score == pytest.approx(s, rel=1e-6) for n, s in known[r.doc_id])
        assert r.n_known == r.n_tokens and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))


def test_fingerprints(messy):
    """Rows with an id of their own; the order of rows that share one is not defined."""
    rows = {r[0]: r[1] or "" for r in messy_rows()}
    several = Counter(r[0] for r in messy_rows())
    for r in parsing.fingerprint_with_next(messy).collect():
        if several[r.doc_id] == 1 and r.doc_id is not None and len(rows[r.doc_id]) < 2000:
            print_of = "".join(f"{n:04x}" for n in _brute_sketch(rows[r.doc_id]))
            assert (r.n_chars, r.fingerprint) == (len(rows[r.doc_id]), print_of)


def test_scores_of_the_classifier(messy):
    model = quality.fit(messy, _labels(messy))
    found = quality.score(messy, model).collect()
    by_text = {}
    for r in found:
        assert r.predicted == (r["score"] >= quality.THRESHOLD) and 0 <= r["score"] <= 1
        assert by_text.setdefault(r.text or "", r["score"]) == pytest.approx(r["score"], abs=1e-6)
    assert by_text[""] == pytest.approx(float(model.labels.mean()))


def test_counts_of_tokens(messy):
    pieces = token_counts.load_pieces()
    found = by_row(token_counts.token_counts(messy), "doc_id", "n_chars", "n_pretokens", "n_tokens")
    wanted = Counter()
    for doc_id, text, *_ in messy_rows():
        text = text or ""
        # A space between two visible characters begins a pre-token.
        cuts = [i for i in range(1, len(text) - 1) if text[i] == " " and not (text[i - 1].isspace() or text[i + 1].isspace())]
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])] if text else []
        words = Counter([" " + parts[0], *parts[1:]] if parts else [])
        tokens = sum(n * one(pieces, w.replace(" ", token_counts.SPACE)) for w, n in words.items())
        wanted[doc_id, len(text), len(parts), tokens] += 1
    assert found == wanted


def test_every_text_is_contaminated_by_itself(messy):
    found = decontamination.decontaminate(messy, messy, item_column="doc_id").collect()
    for r in found:
        assert r.n_hit == r.n_words
        assert (str(r.doc_id) in r["items"]) == (r.n_words > 0 and r.doc_id is not None)
    assert {tuple(r["items"]) for r in found if r.doc_id in (1, 2)} == {("1", "2", "3")}

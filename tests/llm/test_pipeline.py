from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tests.llm.conftest import prose
from tests.llm.test_simhash import brute_fingerprint, brute_roots
from tidyledger.llm.common import quoted


@pytest.fixture(scope="module")
def stages(spark, sample, tmp_path_factory):
    """What each stage returns, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    found = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sample)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found[name] = docs.collect()
    return found


def test_quality_keeps_clean_documents(spark, sample, stages):
    kept = {r.doc_id for r in stages["quality"]}
    labels = spark.read.parquet(f"{sample}/labels.parquet").collect()
    good = [r.doc_id for r in labels if r.quality == 1]
    assert sum(d in kept for d in good) >= 0.97 * len(good)
    bad = [r.doc_id for r in labels if r.quality == 0]
    assert sum(d in kept for d in bad) <= 0.3 * len(bad)


def test_exact_dedup_keeps_the_largest_id_of_each_text(stages):
    groups = defaultdict(list)
    for r in stages["quality"]:
        groups[r.text].append(r.doc_id)
    assert sorted(r.doc_id for r in stages["exact_dedup"]) == sorted(map(max, groups.values()))


def test_one_of_each_near_group_stays(stages):
    rows = sorted(stages["exact_dedup"], key=lambda r: r.doc_id)
    roots = brute_roots([brute_fingerprint(r.text) for r in rows], 4)
    assert sorted(r.doc_id for r in stages["simhash"]) == [rows[i].doc_id for i in sorted(set(roots))]


def test_mix_is_one_and_a_half_times_the_words(stages):
    def words(rows):
        return sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows)

    before = words(stages["simhash"])
    assert abs(words(stages["mixing"]) - 1.5 * before) <= 40
    texts = {r.doc_id: r.text for r in stages["simhash"]}
    assert all(texts[r.doc_id].startswith(r.text) for r in stages["mixing"])


def test_packing_takes_every_row_of_the_mix(stages):
    wanted, found = defaultdict(int), defaultdict(int)
    for r in stages["mixing"]:
        wanted[r.doc_id] += 1
    for r in stages["packing"]:
        found[r.doc_id] += r.start == 0
    assert found == wanted


def test_run_gives_the_same_rows(spark, sample, stages):
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    got = corpus_pipeline.run(spark, sample)
    assert sum(r.length for r in got.collect()) == sum(r.length for r in stages["packing"])
    assert set(key) <= set(got.columns)


def test_registered(spark):
    import __spark_entry__

    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


def test_one_row_stays_of_repeated_and_null_ids(spark, sample):
    """Near-equal texts under one id, under none, and in groups without any id."""
    one, two, three = prose(21, 300), prose(22, 300), prose(23, 300)
    rows = [
        *[(5, one), (5, one + " end"), (5, one + " end"), (9, one), (None, one), (None, "so " + one)],
        *[(None, two), (None, two + " end"), (None, two)],
        *[(None, three), (None, three + " end")],
        (7, prose(24, 300)),
    ]
    docs = spark.createDataFrame([(*r, "s", i) for i, r in enumerate(rows)], "doc_id long, text string, source string, size int")
    found = corpus_pipeline.keep_representatives(spark, docs.repartition(4), sample).collect()
    at = {i: (0, 6, 9, 11)[sum(i >= x for x in (6, 9, 11))] for i in range(len(rows))}
    roots = brute_roots([brute_fingerprint(text) for _, text in rows], 4)
    assert [at[i] == at[j] for i in at for j in at] == [roots[i] == roots[j] for i in at for j in at]
    assert sorted(at[r["size"]] for r in found) == [0, 6, 9, 11]
    assert {at[r["size"]]: r.doc_id for r in found} == {0: 5, 6: None, 9: None, 11: 7}
    assert all((r.doc_id, r.text) == rows[r["size"]] for r in found)


def test_which_of_repeated_rows_stays_does_not_depend_on_their_order(spark, sample):
    text = prose(31, 200)
    rows = [(1, text, source, n) for source in ("b", "a", None) for n in (3, 2)] + [(2, text + " end", "a", 1)]
    for turn in range(3):
        docs = spark.createDataFrame(rows[turn:] + rows[:turn], "doc_id long, text string, source string, `n.x` int")
        found = corpus_pipeline.keep_representatives(spark, docs.repartition(3), sample).collect()
        assert [tuple(r) for r in found] == [(1, text, "a", 2)]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_messy_and_empty_tables(spark, sample, messy, empty, name, stage):
    """Input columns named like those of operators come back with their own values."""
    assert stage(spark, empty, sample).count() == 0
    out = stage(spark, messy, sample)
    if name == "packing":
        out.collect()
        return
    assert out.dtypes == messy.dtypes
    left = [quoted(c) for c in messy.columns if not (name == "mixing" and c == "text")]
    before = Counter(messy.select(*left).collect())
    after = Counter(out.select(*left).collect())
    assert after and all(before[row] * (2 if name == "mixing" else 1) >= n for row, n in after.items())

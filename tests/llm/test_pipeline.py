"""The corpus pipeline, stage by stage, against brute force."""

import pytest

import corpus_pipeline

from .conftest import shingles_of, words_of
from .test_dedup_ops import brute_near, brute_windows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage over the smallest documents and some odd rows."""
    folder = str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    odd = [(-1, None), (-2, ""), (-3, "123 456"), (10_000, first.text), (10_001, first.text + " and more"), (10_001, first.text + " and more")]
    more = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], docs.schema)
    docs.unionByName(more).selectExpr("*", "'x' AS score", "1 AS c0").write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    at, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, at, folder).write.parquet(f"{folder}/{name}")
        done = spark.read.parquet(f"{folder}/{name}")
        out.append((at, done))
        at = done
    return out


def rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "decontamination", "sentencepiece"]
    for before, after in stages[:-1]:
        assert after.columns == before.columns
    assert {r.score for r in stages[-2][1].collect()} == {"x"}


def test_language_stage_drops_texts_without_language(stages):
    before, after = stages[0]
    assert {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()} == {-1, -2, -3}


def test_near_duplicates_leave_one(stages):
    before, after = (rows(x) for x in stages[1])
    kept = {i for i, _, group in brute_near(before, 5) if i == group}
    assert after == sorted({(i, t) for i, t in before if i in kept}, key=repr)


def test_repeated_windows_go(stages):
    before, after = (rows(x) for x in stages[2])
    want = []
    texts = dict(before)
    for i, n, gone, kept in brute_windows(before, 20):
        if n > gone:
            want.append((i, kept if gone else texts[i]))
    assert after == sorted(want, key=repr)
    assert all(r.n_chars == len(r.text) for r in stages[2][1].collect())


def test_documents_with_items_go(spark, stages):
    before, after = (rows(x) for x in stages[3])
    items = [shingles_of(r.text, 5) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [(i, t) for i, t in before if not any(5 * len(s & shingles_of(t, 5)) >= 4 * len(s) for s in items)]
    assert after == clean and all(len(words_of(t)) > 0 for _, t in after)


def test_pieces_decode_to_the_text(stages):
    for r in stages[4][1].collect():
        assert r.decoded == r.text and r.n_pieces == len(r.piece_ids)


def test_near_duplicates_of_rows_with_maps_and_without_ids(spark):
    text = "one two three four five six seven eight"
    rows = [(1, text, {"a": 1}), (1, text, {"a": 1}), (2, text, {"b": 2}), (None, text, {"c": 3}), (None, None, {}), (3, "another", None), (1, text, {"a": 5})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>").selectExpr("*", "'x' AS c0", "'y' AS kept_id")
    got = corpus_pipeline.near_dedup(spark, docs, SF)
    assert got.columns == docs.columns
    have = sorted(((r.doc_id, r.m) for r in got.collect()), key=repr)
    assert have == sorted([(1, {"a": 1}), (1, {"a": 5}), (3, None), (None, {"c": 3}), (None, {})], key=repr)


def test_texts_in_several_languages_stay(spark):
    docs = {r.lang: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 2000").collect()}
    mixed = " ".join(docs[k][:700] for k in ("en", "de", "fr"))
    train = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**9, mixed, None, None, None), (10**9 + 1, "123", None, None, None)], train.schema)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, train.unionByName(extra), SF).collect()}
    assert 10**9 in kept and 10**9 + 1 not in kept

"""The pipeline's stages against plain versions of what each decides."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowgauge.session import new_folder

import brute
from test_operators import check_packing

#: Names that the operators' results have.
CLASH = ["fp", "row", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256", "clean", "n_words", "n_hit", "items", "spans", "lang_pred", "score", "letters"]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, small):
    """The rows before and after each stage."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs.collect()]
    for _, function in corpus_pipeline.STAGES:
        path = new_folder(spark, "stage")
        function(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def texts(rows):
    return sorted((r.doc_id, r.text) for r in rows)


def test_order_and_columns(spark, small, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination", "packing"]
    assert all(rows[0].__fields__ == stages[0][0].__fields__ for rows in stages[:5])
    assert corpus_pipeline.run(spark, small).count() == len(stages[5])


def test_languages_drop_only_texts_without_one(stages):
    gone = {r.doc_id for r in stages[0]} - {r.doc_id for r in stages[1]}
    assert all(not any(c.isalpha() for c in r.text or "") for r in stages[0] if r.doc_id in gone)


def test_near_duplicates_leave_the_first(stages):
    docs = texts(stages[1])
    root = brute.linked([brute.fingerprint(t) for _, t in docs])
    assert texts(stages[2]) == [d for k, d in enumerate(docs) if root[k] == k]


def test_earlier_strings_are_cut(stages):
    import hashlib

    docs = texts(stages[2])
    want = {i: x for (i, _), x in zip(docs, brute.earlier(docs))}
    for r in stages[3]:
        if want[r.doc_id][1] == 0:
            assert hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id][3]
        assert r.n_chars == len(r.text)


def test_benchmark_passages_are_cut(spark, small, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    docs = texts(stages[3])
    hit = {i: x[1] for (i, _), x in zip(docs, brute.hits([t for _, t in docs], items))}
    after = dict(texts(stages[4]))
    assert all((after[i] == t) == (hit[i] == 0) for i, t in docs)
    assert sum(map(bool, hit.values())) > 0


def test_packed(stages):
    check_packing(texts(stages[4]), stages[5])


def test_odd_rows(spark, small):
    rows = [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "...", None, "a", 3), (4, "plain words here", "en", None, None), (4, "plain words here", "en", None, None), (None, "other words there", None, None, 5), (5, "qzx" * 300, "en", "a", 900)]
    path = new_folder(spark, "odd-docs")
    spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit(1) for c in CLASH}).write.parquet(path)
    docs = spark.read.parquet(path)
    for n, (_, function) in enumerate(corpus_pipeline.STAGES):
        path = new_folder(spark, "odd-stage")
        function(spark, docs, small).write.parquet(path)
        docs = spark.read.parquet(path)
        if n == 0:
            assert {r.text for r in docs.collect()} >= {"plain words here", "other words there"} and docs.where("text IS NULL OR text IN ('', '...')").count() == 0
        assert n == 4 or docs.columns == [*(c.split()[0] for c in COLUMNS.split(", ")), *CLASH]
        if n == 1:
            assert docs.where("doc_id = 4").count() == 1
    assert docs.agg(F.sum("length")).first()[0] > 0


@pytest.mark.parametrize("stage", range(5))
def test_no_rows(spark, small, stage):
    docs = spark.createDataFrame([], COLUMNS)
    assert corpus_pipeline.STAGES[stage][1](spark, docs, small).count() == 0

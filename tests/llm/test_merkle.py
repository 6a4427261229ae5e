"""The manifest of a table against a plain version, proofs of some leaves, and the fewest missing nodes."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

import brute
from llm import merkle
from llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
ODD = [
    (1, "a", "en", 3, "Abc"), (2, None, None, None, None), (None, "b", "en", 0, ""), (4, "", "", 5, "É A"), (4, "", "", 5, "É A"), (4, "", "", 5, "other"),
    (6, "s", "zz", 1, "\x00Z"), (7, "s", "é", 1, "x" * 20000), (-9, "s", "de", 1, "-"), (9, "1:", "de", -1, "3:abc"),
]


def same(got, rows):
    return sorted(map(tuple, got), key=repr) == sorted(brute.merkle(rows), key=repr)


def altered():
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_digest(text=merkle.lowered(F.col("text"))))


def proofs(docs, **more):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return merkle.verify(merkle.build(docs, altered=altered()), F.coalesce("altered", "leaf"), "doc_id", **more).select(*columns)


@pytest.mark.parametrize("n", [0, 1, 2, len(ODD)])
def test_odd_rows(spark, n):
    docs = spark.createDataFrame(ODD[:n], SCHEMA).repartition(3)
    docs = docs.withColumns({c: F.lit("x") for c in ("leaf", "tree", "pos", "digest", "size", "part", "chunk", "run", "place", "own", "apart")})
    assert same(proofs(docs).collect(), ODD[:n])


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    assert same(QUERIES["op11_merkle"](spark, small).collect(), list(map(tuple, rows)))


def test_many_trees_and_tall_ones(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RISE", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = [(k, "s", f"l{k % 70}" if k % 2 else "en", k, f"Text {k}") for k in range(700)]
    assert same(proofs(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect(), rows)


def test_proofs_of_some_leaves_fold_to_the_root(spark):
    rows = [(k, "s", "en" if k % 3 else "de", k, f"Text {k}") for k in range(300)]
    got = proofs(spark.createDataFrame(rows, SCHEMA).repartition(4), which=F.col("doc_id") % 50 == 7).collect()
    want = [r for r in brute.merkle(rows) if r[0] % 50 == 7]
    assert sorted(map(tuple, got)) == sorted(want)


def test_a_forged_leaf_is_not_verified(spark):
    rows = [(k, "s", "en", k, f"text {k}") for k in range(20)]
    manifest = merkle.build(spark.createDataFrame(rows, SCHEMA))
    got = merkle.verify(manifest, F.when(F.col("doc_id") == 3, F.sha2(F.lit("forged"), 256)).otherwise(F.col("leaf")), "doc_id", with_proof=True).collect()
    assert {r.doc_id for r in got if not r.verified} == {3}
    assert all(len(r.proof) == 64 * (7 + 2 if r.doc_id < 16 else 3 + 2) for r in got)


@pytest.mark.parametrize("size", [1, 2, 8, 9, 65])
def test_the_missing_nodes_are_the_fewest(size):
    for places in itertools.chain([[k] for k in range(size)], [[0, size - 1], range(size), range(0, size, 3)]):
        found = merkle.missing(places, size)
        covers = [set(range(i * 8**level, min((i + 1) * 8**level, size))) for level, i in found]
        # together with the leaves they cover all, none twice, and none could stand one level higher
        assert sorted(itertools.chain(set(places), *covers)) == list(range(size))
        for level, i in found:
            up = i // 8
            assert set(places) & set(range(up * 8 ** (level + 1), (up + 1) * 8 ** (level + 1)))

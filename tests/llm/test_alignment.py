"""Token alignment against a plain merge of whole texts' tokens."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import brute
from llm import alignment
from llm.alignment import PairEncoder, align, common_ends
from llm.queries import QUERIES, tokenizer_json

SCHEMA = "doc_id long, text string"
MODEL = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
TEXTS = [
    None, "", " ", "  ", "x", "x ", " x", "\n", "\nx", "a\r\nb;\r {\r\n\r}", "\r", "one  two   three    four\t\tfive \n six", "<|endoftext|> a<|endoftext|>b <s>x</s> <0x41> <unk>",
    "a▁b", "▁", "ünïcode wörds 日本語テキスト 🙂🙃🙂 ﬁ Å Å", "x　y z w", "zero\x00byte \x7f", "y" * 3000, "é" * 500, "🙂" * 700, "12,345.67 don't I'll we've ...!!! ((())) --- ====",
    "def f(x):\n    return {\"a\": [1, 2.5e-3]}\n\n\t# done\r\n", "the same the same the same", "the same the same the same", "مرحبا بالعالم नमस्ते दुनिया สวัสดี", "  　 wide",
]


def same(got, rows):
    return sorted(map(tuple, got), key=repr) == sorted(brute.alignments(rows), key=repr)


def run(docs, **more):
    return align(docs, tokenizer_json("byte_bpe_50k.json"), MODEL, "doc_id", **more).collect()


@pytest.fixture(scope="module")
def odd():
    return [*enumerate(TEXTS), (3, "x"), (None, "no id"), (3, "x")]


def test_odd_rows(spark, odd):
    docs = spark.createDataFrame(odd, SCHEMA).repartition(3)
    clash = docs.withColumns({c: F.lit("x") for c in ("row", "bundle", "rows", "blob", "firsts", "n_a", "n_links", "place", "a", "b", "n", "signed")})
    assert same(run(clash), odd)
    assert align(docs, tokenizer_json("byte_bpe_50k.json"), MODEL).count() == len(odd)
    assert run(docs.limit(0)) == []


def test_long_texts_in_slices(spark, odd, monkeypatch):
    monkeypatch.setattr(alignment, "WIDE_GROUP", 3)
    monkeypatch.setattr(alignment, "STRETCH", 5)
    docs = spark.createDataFrame([*odd, (90, " ".join(t or "" for t in TEXTS) * 3)], SCHEMA).repartition(2)
    assert same(run(docs, limit=40), docs.collect())


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert same(QUERIES["op12_alignment"](spark, small).collect(), rows)


@pytest.mark.parametrize("stretch", [1, 3, 64])
def test_common_ends_of_random_arrays(stretch):
    rng = random.Random(stretch)
    for share in (0.02, 0.3, 0.7, 1.0):
        n = rng.randint(1, 900)
        a, b = (sorted({k for k in range(n) if rng.random() < share} | {n}) for _ in range(2))
        in_a, in_b = common_ends(np.array(a), np.array(b), stretch)
        both = set(a) & set(b)
        assert in_a.tolist() == [x in both for x in a]
        assert in_b.tolist() == [x in both for x in b]


def test_ids_of_parts_are_those_of_whole_texts():
    pair = PairEncoder(tokenizer_json("byte_bpe_50k.json"), MODEL)
    _, _, ids_a, ids_b = brute.token_bytes()
    rng = random.Random(1)
    words = ["a", "the", "é", "x;", "{", "}", "\r", "\r\n", "\n", "\t", " ", "  ", "don't", "日本", "0.5", ";", "\x0b", "\x0c", "▁", "🙂"]
    texts = ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    raw = [(" " + t).encode() for t in texts]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    a, counts_a, b, counts_b, good = pair.encode(data, np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    for t, x, y, whole in zip(texts, np.split(a, np.cumsum(counts_a)[:-1]), np.split(b, np.cumsum(counts_b)[:-1]), good):
        assert whole == ("▁" not in t)
        if whole:
            assert x.tolist() == ids_a(" " + t)
            assert y.tolist() == ids_b(t)

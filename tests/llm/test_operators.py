"""Every operator against its plain version, on odd rows and on the smallest tables."""

from __future__ import annotations

import base64
import hashlib
import json
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import __spark_entry__ as spark_entry
from flowgauge.session import new_folder
from llm import contexts, decontaminate, deep_shallow, languages, neighbours, packing, simhash, substrings, suffixes, token_files, tokens, warc
from llm.common import chunks, words
from llm.components import components
from llm.queries import QUERIES, tokenizer_json

import brute

PASSAGE = " ".join(f"passage{k}" for k in range(60))
ODD = [
    (5, None), (3, ""), (9, " \n\t "), (1, "x"), (2, "One two three"), (4, f"head {PASSAGE} tail"), (7, f"{PASSAGE}"), (6, f"é {PASSAGE}\n\n{PASSAGE} ü"),
    (8, "Ünïcode  wörds and　spaces 日本語 🙂🙂 don't I'll 12,345.67"), (10, "a " * 3000), (11, "a " * 3000), (12, "y" * 9000), (13, "<|endoftext|> odd"),
    (None, f"no id {PASSAGE}"), (4, f"head {PASSAGE} tail"), (14, "one TWO three"), (15, "é" * 70), (16, "x" + "é" * 70),
]
DOCUMENT = "doc_id long, text string"
#: Names that operators use themselves.
CLASH = ["part", "bundle", "payload", "blob", "fp", "cell", "start", "length", "sequence_id", "shard", "score", "n_words", "kept", "lang_pred", "capture_id", "_row"]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, DOCUMENT).repartition(3)
    return df.withColumns({c: F.lit("x") for c in CLASH})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="module")
def documents(spark, small):
    return [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


def multiset(rows):
    return sorted(rows, key=repr)


def check_packing(docs, rows):
    ids = defaultdict(list)
    for (i, _), own in zip(docs, brute.token_ids([t for _, t in docs], "byte_bpe_50k.json")):
        ids[i].append(own)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert any(brute.crc(own[r.start : r.start + r.length]) == r.ids_crc32 and len(own) == r.doc_tokens for own in ids[r.doc_id])
        pieces[r.doc_id] += range(r.start, r.start + r.length)
        sequences[r.sequence_id].append((r.offset, r.length, r.tier, r.padded_to))
    assert {i: sorted(p) for i, p in pieces.items()} == {i: sorted(k for own in o for k in range(len(own))) for i, o in ids.items()}
    for own in sequences.values():
        at = 0
        for offset, length, tier, padded in sorted(own):
            assert offset == at
            at += length
        assert at == tier <= 2048 and padded == (at if at & (at - 1) == 0 else 2048)


# --- 1 packing ------------------------------------------------------------------------


def test_packing_odd(odd, none):
    definition = tokenizer_json("byte_bpe_50k.json")
    rows = packing.pack_documents(odd, definition, with_ids=True).collect()
    check_packing(ODD, rows)
    assert all(len(r.ids) == r.length for r in rows)
    assert packing.pack_documents(none, definition).count() == 0


def test_packing_query(spark, small, documents):
    check_packing(documents, QUERIES["op1_packing"](spark, small).collect())


def test_gaps_are_filled_from_shorter_tiers():
    pool = packing.Pool((4, 8))
    for piece in ((5, 0, 0), (2, 1, 0), (4, 2, 0)):
        pool.add(piece)
    assert list(pool.windows(False)) == [[(5, 0, 0), (2, 1, 0), (1, 2, 0)]]
    assert list(pool.windows(True)) == [[(2, 2, 1)], [(1, 2, 3)]]


def test_step_groups_are_level():
    groups = packing.step_groups([8, 8, 4, 4, 4, 2, 2], 16)
    sums = defaultdict(int)
    for size, g in zip([8, 8, 4, 4, 4, 2, 2], groups):
        sums[g] += size
    assert sorted(sums.values()) == [16, 16]


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_have_the_ids_of_whole_texts(file, documents):
    odd_texts = ["", " ", " a ", "x  y \n z  w", "\n\n a\n\nb  c ", "don't 'S I'll", "a   b  c\u0085\nd", "éa ́b ΣΑΣ Σ", "\x1c\x01 a\x01", "x" * 300, "ﬁ ǅ İ i̇", "​ a"]
    # capitals that compose with a mark only in lower case, or not at all
    marked = ["H\u0331ello", "T\u0308a W\u030a Y\u030a J\u030c", "aT\u0308 H\u0331H X", "ÀB CÉ İSTANBUL"]
    odd_texts += [*marked, " plain Words ".join(marked) * 30]
    texts = odd_texts + [t for _, t in documents[:60]]
    encode = tokens.TextEncoder(tokenizer_json(file)).encode
    for _, data, offsets in chunks([pa.RecordBatch.from_pydict({"text": texts})], limit=5000):
        ids, counts = encode(data, offsets)
        own = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
        want = [x[:-1].tolist() for x in brute.token_ids(own, file)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_do_not_depend_on_what_is_remembered(file, documents, monkeypatch):
    texts = [t for _, t in documents[:60]] * 2
    monkeypatch.setattr(tokens, "REMEMBERED", 300)
    encoder = tokens.TextEncoder(tokenizer_json(file))
    want = [x[:-1].tolist() for x in brute.token_ids(texts, file)]
    for n in range(0, len(texts), 10):
        data = np.frombuffer("".join(texts[n : n + 10]).encode(), dtype=np.uint8)
        ids, counts = encoder.encode(data, np.cumsum([0, *(len(t.encode()) for t in texts[n : n + 10])]))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want[n : n + 10]


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_in_a_text_are_these_tokens(file):
    texts = ["<|endoftext|>", "a  <|endoftext|>b c", "one<|endoftext|><|startoftext|>two <|endoftext|> \n x", "<|ENDOFTEXT|> A<|EndOfText|>B", "Ab<|startoftext|>É <|endoftext|", "A<|ENDOFTEXT|>B<|endoftext|>C", "x\u3000 <|endoftext|>  y", "<|endof text|> é<|endoftext|>" + "y" * 70]
    plain = Tokenizer.from_file(public_tokenizers.path(file))
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [50256 if file.startswith("byte") else 49407]
    for _, data, offsets in chunks([pa.RecordBatch.from_pydict({"text": texts})]):
        ids, counts = tokens.TextEncoder(tokenizer_json(file)).encode(data, offsets)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_recurring_pieces_stay_known(monkeypatch):
    """When the memory is full, words that came again are kept: the tokenizer sees each of them once."""
    monkeypatch.setattr(tokens, "REMEMBERED", 100)
    encoder, seen = tokens.TextEncoder(tokenizer_json("word_bpe_49k.json")), Counter()
    fresh = encoder.fresh
    monkeypatch.setattr(encoder, "fresh", lambda pieces, joined: seen.update(pieces) or fresh(pieces, joined))
    usual, full = [f"usual{n}" for n in range(30)], Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for n in range(20):
        text = " ".join([*usual, *(f"once{n}x{k}" for k in range(40))])
        ids, _ = encoder.encode(np.frombuffer(text.encode(), dtype=np.uint8), np.array([0, len(text)]))
        assert ids.tolist() == full.encode(text, add_special_tokens=False).ids
    assert {seen[w.encode()] for w in usual} == {1} and len(encoder.known) < 200


@pytest.mark.parametrize("accents", ["kept", "stripped"])
def test_joined_words_have_the_whole_tokenizers_ids(accents):
    """Whatever letter, mark, control or white space a word holds, and whatever the normalizer does to it."""
    definition = json.loads(tokenizer_json("word_bpe_49k.json"))
    if accents == "stripped":
        definition["normalizer"]["normalizers"] = [{"type": "NFD"}, {"type": "StripAccents"}, *definition["normalizer"]["normalizers"][1:]]
    definition = json.dumps(definition)
    signs = [chr(c) for c in range(1, 0x370)] + list("\u1e9e\u212b\u1100\u1161\u3000\u200b")
    texts = [" ".join(f"{c}b a{c} A{c}B {c}{c}" for c in signs), *(f"word {c} A{c}\u0301 x{c}y" for c in signs)]
    full, encoder = Tokenizer.from_str(definition), tokens.TextEncoder(definition)
    assert encoder.kind == "word" and (encoder.joiner is encoder.tokenizer) == (accents == "stripped")
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    ids, counts = encoder.encode(data, np.cumsum([0, *(len(t.encode()) for t in texts)]))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [full.encode(t, add_special_tokens=False).ids for t in texts]


# --- 2 substrings ---------------------------------------------------------------------


def digests(rows, *names):
    return multiset((r.doc_id, *(r[n] for n in names)) for r in rows)


def test_repeats_odd(odd, none):
    rows = substrings.remove_repeats(odd, with_text=True).collect()
    want = [(i, *x) for (i, _), x in zip(ODD, brute.repeats(ODD))]
    assert digests(rows, "n_words", "n_removed", "kept_sha256") == multiset(want)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in rows)
    assert substrings.remove_repeats(none).count() == 0


def test_repeats_survive_a_sketch_that_is_full(odd, monkeypatch):
    monkeypatch.setattr(substrings, "LARGEST_ROW", 64)
    want = [(i, *x) for (i, _), x in zip(ODD, brute.repeats(ODD, 5))]
    assert digests(substrings.remove_repeats(odd, window=5).collect(), "n_words", "n_removed", "kept_sha256") == multiset(want)


def test_repeats_query(spark, small, documents):
    want = [(i, *x) for (i, _), x in zip(documents, brute.repeats(documents))]
    assert digests(QUERIES["op2_substrings"](spark, small).collect(), "n_words", "n_removed", "kept_sha256") == multiset(want)


# --- 3 SimHash ------------------------------------------------------------------------


def components_of(docs):
    fps = [brute.fingerprint(t) for _, t in docs]
    root = brute.linked(fps)
    least = {}
    for (i, _), r in zip(docs, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [(i, f"{f:016x}", least.get(r)) for (i, _), f, r in zip(docs, fps, root)]


def test_simhash_odd(odd, none):
    got = [tuple(r) for r in simhash.near_duplicates(odd).collect()]
    assert multiset(got) == multiset(components_of(ODD))
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_keeps_one_of_each(spark, odd, none):
    stored = new_folder(spark, "odd")
    odd.write.parquet(stored)
    kept = simhash.keep_one(spark.read.parquet(stored))
    assert kept.columns == odd.columns
    want = {c for _, _, c in components_of(ODD) if c is not None}
    rows = kept.collect()
    assert len(rows) == len(set(components_of(ODD)[k][2] for k in range(len(ODD)))) and {r.doc_id for r in rows if r.doc_id is not None} == want
    assert simhash.keep_one(none).count() == 0


def test_simhash_query(spark, small, documents):
    assert multiset(tuple(r) for r in QUERIES["op3_simhash"](spark, small).collect()) == multiset(components_of(documents))


@pytest.mark.parametrize("bits", [2, 4, 5, 7])
def test_links_join_all_fingerprints_that_are_near(spark, bits):
    rng = np.random.default_rng(bits)
    fps = [int(x) for x in rng.integers(0, 1 << 63, 30, dtype=np.uint64)]
    for f in fps[:30]:
        for _ in range(4):
            flips = rng.choice(64, int(rng.integers(1, bits + 3)), replace=False)
            fps.append(f ^ sum(1 << int(b) for b in flips))
    fps = list(dict.fromkeys(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    roots = {r.node: r.root for r in components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), bits)).collect()}
    got = [roots.get(x, x) for x in signed]
    want = brute.linked(fps, bits)
    assert len({*zip(got, want)}) == len(set(got)) == len(set(want))


def test_the_manhattan_distance_is_a_lower_bound():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 1 << 63, (2, 2000), dtype=np.uint64)
    y[:1000] = x[:1000] ^ (np.uint64(1) << rng.integers(0, 64, 1000, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 1000, dtype=np.uint64))
    counts = lambda v: np.stack([np.bitwise_count(v >> np.uint64(k) & np.uint64(3)) for k in range(0, 64, 2)], axis=1).astype(int)
    distance = np.abs(counts(x) - counts(y)).sum(axis=1)
    assert (np.bitwise_count(simhash.unary(x) ^ simhash.unary(y)) == distance).all()
    bits = np.bitwise_count(x ^ y)
    # it rejects most of what the bits reject, and nothing that they do not
    assert (distance <= bits).all() and ((distance > 4) & (bits > 4)).sum() > 900


def test_components_of_a_chain_a_star_and_nulls(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(50)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, **{200 + k: 100 for k in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 4 neighbours ---------------------------------------------------------------------


def recall(vectors, rows, every, k=20):
    got = defaultdict(list)
    for r in rows:
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    ids = np.array([i for i, _ in vectors])
    matrix = np.array([v for _, v in vectors], dtype=np.float64)
    hit = total = 0
    for q in ids[ids % every == 0]:
        scores = (matrix * matrix[ids == q][0]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, min(k, len(ids) - 1) + 1))
        exact = dict(zip(ids.tolist(), scores.tolist()))
        assert all(abs(exact[i] - s) < 1e-9 for _, i, s in mine)
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        hit += len({int(ids[i]) for i in order} & {m[1] for m in mine})
        total += len(order)
    return hit / total


def test_neighbours_query(spark, small):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    assert recall(vectors, QUERIES["op4_neighbours"](spark, small).collect(), 20) >= 0.95


def test_neighbours_odd(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(x) for x in np.float32(rng.standard_normal(70))]) for i in range(300)]
    good += [(i, good[0][1]) for i in range(300, 340)]
    bad = [(1000, None), (1020, [0.0] * 70), (1040, [None] + [1.0] * 69), (1060, [float("nan")] * 70), (1080, [1.0, 2.0]), (None, [1.0] * 70), (1100, [float("inf")] * 70)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>").withColumn("shard", F.lit(1)).withColumn("score", F.lit(2)).repartition(2)
    rows = neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect()
    assert recall(good, rows, 20) >= 0.95
    # the copies of vector 0 tie, the smaller ids win
    assert [r.vec_id for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == 0] == list(range(300, 320))
    few = neighbours.nearest(df.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert sorted(r["rank"] for r in few) == [1, 2]
    assert neighbours.nearest(df.where("vec_id >= 1000"), F.col("vec_id") == 1000).count() == 0
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


# --- 5 suffixes -----------------------------------------------------------------------


def test_earlier_odd(odd, none):
    names = "n_bytes", "n_removed", "n_spans", "kept_sha256"
    rows = suffixes.remove_earlier(odd, "fp", with_text=True).collect()
    assert digests(rows, *names) == multiset((i, *x) for (i, _), x in zip(ODD, brute.earlier(ODD)))
    assert all(r.fp == "x" for r in rows) and {r.kept for r in rows if r.doc_id == 2} == {"One two three"}
    assert suffixes.remove_earlier(none).count() == 0


@pytest.mark.parametrize("length", [17, 30])
def test_earlier_in_few_letters(spark, length):
    rng = np.random.default_rng(length)
    docs = [(int(i), "".join(rng.choice(list("ab"), int(rng.integers(0, 400))))) for i in rng.permutation(30)]
    docs += [(100 + i, t[5:200] + "é" + t[:90]) for i, t in docs[:10]]
    rows = suffixes.remove_earlier(spark.createDataFrame(docs, DOCUMENT).repartition(4), length=length).collect()
    assert digests(rows, "n_bytes", "n_removed", "n_spans", "kept_sha256") == multiset((i, *x) for (i, _), x in zip(docs, brute.earlier(docs, length)))


def test_windows_of_a_hot_anchor_are_dealt_apart(spark, monkeypatch):
    """A passage in every document, between texts that differ: no task sorts most of the windows at its edges."""
    rng = np.random.default_rng(3)
    own = ["".join(rng.choice(list("abcdefghijklmnop"), 80)) for _ in range(400)]
    docs = [(k, f"{own[2 * k]} The same passage of sixty bytes or so is in each of them. {own[2 * k + 1]}") for k in range(200)]
    docs += [(300, docs[7][1]), (301, docs[9][1][20:])]
    monkeypatch.setattr(suffixes, "HOT_ANCHOR", 100, raising=False)
    asked, answer = [], suffixes.answer
    monkeypatch.setattr(suffixes, "answer", lambda *given: asked.append(given[0]) or answer(*given))
    rows = suffixes.remove_earlier(spark.createDataFrame(docs, DOCUMENT).repartition(4)).collect()
    assert digests(rows, "n_bytes", "n_removed", "n_spans", "kept_sha256") == multiset((i, *x) for (i, _), x in zip(docs, brute.earlier(docs)))
    windows = defaultdict(int)
    for r in asked[1].collect():
        windows[r.part] += int((suffixes.unsqueeze(r.payload, "<i8", "<u4", "<u4", "u1", "u1", "<u4", "<u4")[3].astype(int) - suffixes.LENGTH + 1).sum())
    assert max(windows.values()) < sum(windows.values()) / 3


def test_earlier_query(spark, small, documents):
    rows = QUERIES["op5_suffixes"](spark, small).collect()
    assert digests(rows, "n_bytes", "n_removed", "n_spans", "kept_sha256") == multiset((i, *x) for (i, _), x in zip(documents, brute.earlier(documents)))


@pytest.mark.parametrize("small_group", [16, 1 << 14])
def test_deep_shallow_sorting(monkeypatch, small_group):
    monkeypatch.setattr(deep_shallow, "SMALL", small_group)
    rng = np.random.default_rng(small_group)
    for letters in (1, 2, 4):
        text = rng.integers(97, 97 + letters, 700).astype(np.uint8)
        text[400:520] = text[100:220]
        at = np.arange(len(text) - 50)
        order, same = deep_shallow.sort_suffixes(text, at, 50)
        raw = text.tobytes()
        found = [raw[i : i + 50] for i in at[order]]
        assert found == sorted(found) and [False] + [a == b for a, b in zip(found, found[1:])] == same.tolist()


# --- 6 languages ----------------------------------------------------------------------


def test_languages_query_on_held_out_documents(spark):
    rows = QUERIES["op6_languages"](spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    out = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and all(r.held_out == brute.held(r.doc_id, 4) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in out]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_odd(spark, odd, none):
    learn = [("en", "the cat and the hat"), ("en", "that is the way"), ("fr", "le chat et la souris"), (None, "nothing"), ("fr", None), ("de", "...")]
    profiles = languages.train_profiles(spark.createDataFrame(learn, "lang string, text string"))
    assert profiles.names == ("en", "fr")
    rows = {r.doc_id: r for r in languages.predict_languages(odd, profiles, "doc_id", "kept").collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (5, 3, 9)) and rows[1].lang_pred in ("en", "fr")
    assert languages.predict_languages(none, profiles, "doc_id").count() == 0
    empty = languages.train_profiles(none.withColumn("lang", F.lit("en")))
    assert empty.names == () and {r.lang_pred for r in languages.predict_languages(odd, empty, "doc_id").collect()} == {"und"}


def test_bound_and_bundled_by_hand():
    texts = ["ab!", "", "..", "A b"]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    grams, doc, at, counts, counted = languages.ngrams(data, offsets, 3)
    got = {(d, "".join(map(chr, grams[g]))): c for d, g, c in zip(doc, at, counts)}
    assert got == {(0, " ab"): 1, (0, "ab "): 1, (3, " a "): 1, (3, "a b"): 1, (3, " b "): 1} and counted.tolist() == [2, 0, 0, 2]
    v = lambda c: languages.letter_vector(ord(c), 1, 64).astype(int)
    want = np.roll(v(" "), 2) * np.roll(v("a"), 1) * v("b")
    assert (languages.bound(np.array([[32, 97, 98]], dtype=np.uint32), 1, 64)[0] == want).all()


# --- 7 contexts -----------------------------------------------------------------------


def check_scores(docs, rows, which):
    want = defaultdict(list)
    for (i, _), x in zip(docs, brute.unigrams(docs)):
        want[i].append(x)
    for r in rows:
        n_tokens, n_known, total, base = min(want[r.doc_id], key=lambda x: abs(x[3] - r.base_score))
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n_tokens, n_known, total, brute.held(r.doc_id, 7))
        assert r.base_score == pytest.approx(base, rel=1e-9)
    scores = defaultdict(list)
    for n, s in zip(which, brute.context_scores(docs, depth=contexts.DEPTH, which=which)):
        scores[docs[n][0]].append(s)
    for r in rows:
        if r.doc_id in scores:
            assert min(abs(s - r.score) / max(1, abs(s)) for s in scores[r.doc_id]) < 1e-6


def test_scores_query(spark, small, documents):
    check_scores(documents, QUERIES["op7_contexts"](spark, small).collect(), range(0, 200, 10))


def test_scores_odd(spark, odd, none):
    named = odd.select("doc_id", "text", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(True)).alias("held_out"), "part")
    rows = contexts.score_texts(named, ~F.col("held_out"), "doc_id", "held_out", "part").collect()
    assert len(rows) == len(ODD)
    check_scores(ODD, rows, range(len(ODD)))
    untrained = contexts.score_texts(named, F.lit(None).cast("boolean"), "doc_id").collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and r.bits_per_byte == pytest.approx(8) for r in untrained)
    assert contexts.score_texts(none, F.lit(True), "doc_id").count() == 0


def test_scores_do_not_depend_on_split_contexts(spark, odd, monkeypatch):
    named = odd.select("doc_id", "text", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(True)).alias("held_out"))
    monkeypatch.setattr(contexts, "SPLIT_KEYS", 20)
    monkeypatch.setattr(contexts, "SPLIT_SHARE", 1000)
    bundled = contexts.bundles(named.withColumn(contexts.LEARN, ~F.col("held_out")), "doc_id", "text", contexts.LEARN)
    dealing = contexts.dealing_of(bundled, 8, contexts.DEPTH)
    assert len(dealing.split) == 3 and all(map(len, dealing.split))
    assert set(contexts.train(bundled, 8).shallow.split) == {2, 3, 4}
    rows = contexts.score_texts(named, ~F.col("held_out"), "doc_id", "held_out").collect()
    check_scores(ODD, rows, range(len(ODD)))


def test_a_hot_pair_of_bytes_is_split(spark, monkeypatch):
    """Most contexts of these texts end in one pair of bytes; their keys lie in many parts."""
    rng = np.random.default_rng(5)
    texts = ["".join(f"{a}{b}e " for a, b in zip(rng.choice(list("abcdfghijk"), 4000), rng.choice(list("lmnopqrstu"), 4000))) for _ in range(4)]
    monkeypatch.setattr(contexts, "SPLIT_KEYS", 50)
    docs = spark.createDataFrame([(k, t, True) for k, t in enumerate(texts)], f"doc_id long, text string, {contexts.LEARN} boolean").repartition(4)
    dealing = contexts.dealing_of(contexts.bundles(docs, "text", contexts.LEARN), 16, contexts.DEPTH)
    data = np.frombuffer(texts[0].encode(), dtype=np.uint8)
    key = np.unique(contexts.stream(data, np.array([0, len(data)]), contexts.DEPTH)[0])
    hot = key[key >> np.uint64(8 * (contexts.DEPTH - 1)) == np.uint64(ord(" ") << 8 | ord("e"))]
    part = contexts.dealt_keys(hot, dealing) >> np.uint64(8 * contexts.DEPTH + 8)
    assert len(hot) > 500 and np.bincount(part.astype(np.int64)).max() < len(hot) / 3


def test_keys_are_merged_in_bounded_groups(monkeypatch):
    monkeypatch.setattr(contexts, "KEYS_AT_ONCE", 5)
    arrays = [np.arange(k, k + 3, dtype=np.uint64) for k in range(20)]
    key, count = contexts.merged_keys((a, np.full(3, 2, dtype=np.uint64)) for a in arrays)
    want = np.unique(np.concatenate(arrays), return_counts=True)
    assert (key == want[0]).all() and (count == 2 * want[1]).all()
    assert [len(g) for g in contexts.together(iter(arrays[:4]))] == [1, 1, 1, 1]


def test_log_gamma():
    from math import lgamma

    x = np.array([0.5, 1.0, 2.5, 7.9, 8.0, 100.5, 1e9])
    assert np.allclose(contexts.log_gamma(x), [lgamma(v) for v in x], rtol=1e-13, atol=1e-13)


# --- 8 decontamination ----------------------------------------------------------------

ITEMS = [(1, "The quick brown fox jumps over the lazy dog and runs away"), (2, "short item"), (3, None), (4, ""), (5, "?!"), (None, "no id item here"), (2, "short item"), (6, "a a a a a a a a a a a")]
TEXTS = [
    (1, "x THE QUICK, brown fox; jumps over the lazy dog and runs away! y"), (2, "quick brown fox jumps over the lazy dog and then"), (3, "Short item short-item no id item here"),
    (4, None), (5, ""), (6, "a " * 30), (7, "short"), (7, "short item"), (None, "one short item"), (8, "short item"), (9, "z " * 20000 + "short item"),
]


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_decontamination_odd(spark, block):
    docs = spark.createDataFrame(TEXTS, DOCUMENT).withColumn("spans", F.lit(1)).repartition(2)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit(1))
    rows = decontaminate.decontaminate(docs, items, "doc_id", phrase_bytes=block).collect()
    got = multiset((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in rows)
    assert got == multiset((i, *x) for (i, _), x in zip(TEXTS, brute.hits([t for _, t in TEXTS], ITEMS)))
    clean = {r.doc_id: (r.clean, [tuple(s) for s in r.spans]) for r in rows}
    assert clean[1] == ("x ! y", [(2, 61)]) and clean[3] == ("", [(0, 37)]) and clean[4] == ("", [])
    assert decontaminate.decontaminate(docs.limit(0), items, "doc_id").count() == 0
    assert {r.n_hit for r in decontaminate.decontaminate(docs, items.limit(0), "doc_id").collect()} == {0}


def test_decontamination_query(spark, small, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    rows = QUERIES["op8_decontaminate"](spark, small).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows}
    want = brute.hits([t for _, t in documents], items)
    assert got == {i: (n, h, len(s), hashlib.sha256(",".join(s).encode()).hexdigest(), h > 0) for (i, _), (n, h, s) in zip(documents, want)}


def test_index_finds_all_places():
    rng = np.random.default_rng(3)
    text = np.append(rng.integers(1, 4, 400), 0)
    text[[50, 51, 200]] = 0
    index = decontaminate.FMIndex(text, 4)
    rows = np.array([[1, 2, 0], [3, 3, 3], [2, 0, 0], [1, 1, 1]])
    lengths = np.array([2, 3, 1, 3])
    low, high = index.search(rows, lengths)
    for row, n, a, b in zip(rows, lengths, low, high):
        want = [k for k in range(len(text) - n + 1) if (text[k : k + n] == row[:n]).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


# --- 9 token files --------------------------------------------------------------------


def check_index(docs, rows):
    ids = brute.token_ids([t for _, t in docs], "word_bpe_49k.json")
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is not None, docs[k][0] or 0))
    starts, at = defaultdict(list), 0
    for k in order:
        starts[docs[k][0]].append((at, len(ids[k]), brute.crc(ids[k])))
        at += len(ids[k])
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.start, r.n_tokens, r.ids_crc32))
    assert {i: sorted(x) for i, x in got.items()} == starts


def test_token_files_odd(spark, odd, none):
    definition = tokenizer_json("word_bpe_49k.json")
    check_index(ODD, token_files.token_index(odd, definition).collect())
    assert token_files.token_index(none, definition).count() == 0
    path = new_folder(spark, "ids")
    token_files.write_token_files(odd, path, definition)
    back = {r.doc_id: list(r.ids) for r in token_files.read_token_files(spark, path, with_ids=True).collect()}
    assert back[2] == brute.token_ids(["One two three"], "word_bpe_49k.json")[0].tolist()


def test_token_files_query(spark, small, documents):
    check_index(documents, QUERIES["op9_token_files"](spark, small).collect())


@pytest.mark.parametrize("count", [0, 1, 3, 4, 5, 1000])
def test_ranks_round_trip(count):
    ranks = np.random.default_rng(count).integers(0, 1 << 32, count, dtype=np.uint64) >> np.random.default_rng(1).integers(0, 32, count, dtype=np.uint64)
    control, codes = token_files.encode_ranks(ranks.astype(np.uint32))
    assert (token_files.decode_ranks(control, codes, count) == ranks).all() and len(control) == -(-count // 4)


# --- 10 WARC --------------------------------------------------------------------------

PAGES = [
    (1, "http://a.org/x y", "<p>one</p>"), (2, "http://b.org/", "<p>one</p>"), (9, None, "<p>one</p>"), (3, "http://c.org", None), (4, "http://d.org/é", ""),
    (5, "http://e.org/\r\nX: y", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"), (6, "no scheme", "long " * 50000), (None, "http://f.org/", "é"), (7, "u", "é"), (8, "", "\n"),
]


def page_digests(pages, least=0):
    keeper, copies = {}, defaultdict(int)
    for i, _, html in pages:
        keeper[html or ""] = max(keeper.get(html or "", -1), -1 if i is None else i)
    out = []
    for i, _, html in pages:
        raw = (html or "").encode()
        refers = keeper[html or ""] if len(raw) >= least and i is not None and keeper[html or ""] != i else None
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if refers is not None else "response", refers))
    return multiset(out)


def read_back(spark, pages, least=0):
    path = new_folder(spark, "warc-test")
    warc.write_warc(pages, path, least)
    return path, warc.assemble(warc.read_warc(spark, path))


def digest_rows(captures):
    return multiset((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.capture_digests(captures).collect())


@pytest.mark.parametrize("least", [0, 5])
def test_warc_odd(spark, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "keeper": F.lit(2), "own": F.lit(3)}).repartition(2)
    _, captures = read_back(spark, pages, least)
    assert digest_rows(captures) == page_digests(PAGES, least)
    rows = captures.collect()
    assert all(len(r.requests) == len(r.metadata) == 1 and r.response is not None for r in rows)
    payloads = {bytes(r.response.payload).decode() for r in rows if r.response.record_type == "response"}
    assert payloads == {h or "" for _, _, h in PAGES}


def test_warc_repeated_and_no_rows(spark):
    twice = spark.createDataFrame([PAGES[0], PAGES[0], PAGES[1]], "page_id long, url string, html string")
    rows = digest_rows(read_back(spark, twice)[1])
    assert [r[3] for r in rows] == ["revisit", "revisit", "response"]
    assert read_back(spark, twice.limit(0))[1].count() == 0


def test_many_equal_pages_are_captures_of_their_own(spark):
    pages = spark.range(20000).select(F.lit(7).cast("long").alias("page_id"), F.lit("http://a.org/").alias("url"), F.lit("<p>same</p>").alias("html"))
    pages = pages.unionByName(spark.createDataFrame([(9, "http://b.org/", "<p>same</p>")], pages.schema))
    captures = read_back(spark, pages)[1]
    found = captures.groupBy(F.size("requests").alias("requests"), F.size("metadata").alias("metadata"), "response.record_type").count().collect()
    assert sorted(map(tuple, found)) == [(1, 1, "response", 1), (1, 1, "revisit", 20000)]
    kept = captures.where("response.record_type = 'response'").first().capture_id
    assert {r.refers_to for r in captures.where("response.record_type = 'revisit'").select("response.refers_to").distinct().collect()} == {kept}


def test_records_without_a_response_stay(spark):
    records = T._parse_datatype_string(warc.RECORDS)
    row = lambda i, kind, to: (i, kind, to, None, None, None, None, None, None)
    found = warc.assemble(spark.createDataFrame([row("a", "response", None), row("b", "request", "a"), row("c", "request", "zz"), row("d", "warcinfo", None)], records)).collect()
    assert {(r.capture_id, r.response is None, len(r.requests or [])) for r in found} == {("a", False, 1), ("zz", True, 1)}


def test_warc_query(spark, small):
    pages = [tuple(r) for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html").collect()]
    rows = multiset((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in QUERIES["op10_warc"](spark, small).collect())
    assert rows == page_digests(pages)


def test_a_broken_archive_is_an_error():
    with pytest.raises(ValueError):
        list(warc.parsed(iter([b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc"])))
    with pytest.raises(ValueError):
        list(warc.parsed(iter([b"HTTP/1.1 200 OK\r\n\r\n"])))


# --- common ---------------------------------------------------------------------------


def test_words_stop_at_documents():
    data = np.frombuffer(b"ab cd ef", dtype=np.uint8)
    starts, ends, at = words(data, np.array([0, 1, 1, 4, 8]), ~np.isin(np.arange(256), [32]))
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [b"a", b"b", b"c", b"d", b"ef"] and at.tolist() == [0, 1, 1, 3, 5]


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in spark_entry.queries() if n.startswith("op")) == list(range(1, 14))


def test_earlier_in_long_repetitive_texts(spark, monkeypatch):
    line = "the same line of some sixty bytes comes again and again and again\n"
    docs = [(1, "y" * 3000), (2, "y" * 4000), (3, line * 60), (4, "x" + line * 70), (5, "ab" * 900), (6, "ba" * 1000 + "c"), (7, "y" * 49), (8, "y" * 50), (9, line * 60 + "z" * 120)]
    want = multiset((i, *x) for (i, _), x in zip(docs, brute.earlier(docs)))
    names = "n_bytes", "n_removed", "n_spans", "kept_sha256"
    for at_once, hot in ((1 << 20, 1 << 16), (700, 50), (64, 5)):
        monkeypatch.setattr(suffixes, "AT_ONCE", at_once)
        monkeypatch.setattr(suffixes, "HOT_ANCHOR", hot)
        rows = suffixes.remove_earlier(spark.createDataFrame(docs, DOCUMENT).repartition(3)).collect()
        assert digests(rows, *names) == want


def test_few_anchors_in_a_run_of_one_letter():
    data = np.frombuffer(b"y" * 100_000 + b"ab" * 50_000 + b"abcdefg" * 20_000, dtype=np.uint8)
    found = suffixes.Anchors(data, np.array([0, 100_000, 200_000, len(data)]), 50)
    assert len(found.place) < len(data) / 8
    # every window has its anchor
    windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(found.first, found.last)])
    assert sorted(windows.tolist()) == [*range(0, 99_951), *range(100_000, 199_951), *range(200_000, len(data) - 49)]
    assert ((found.place >= found.last) & (found.place + 16 <= found.first + 50)).all()

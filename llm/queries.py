"""The registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.session import new_folder
from llm import alignment, contexts, decontaminate, languages, merkle, near_vectors, neighbours, packing, simhash, substrings, suffixes, token_files, warc
from llm.common import ship, table


def tokenizer_json(name: str) -> str:
    """The definition of one of the installed public tokenizers."""
    return Path(public_tokenizers.path(name)).read_text()


def held_out(folds: int) -> Column:
    """Rows whose crc32 of the doc_id as text leaves 2; a row without doc_id is held out too."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 2, F.lit(True))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_json("byte_bpe_50k.json"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_earlier(table(spark, sf_dir, "documents"))


def op6_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = languages.train_profiles(docs, ~held_out(4))
    return languages.predict_languages(docs.select("doc_id", held_out(4).alias("held_out"), "text"), profiles, "doc_id", "held_out")


def op7_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out(7).alias("held_out"), "text")
    return contexts.score_texts(docs, ~F.col("held_out"), "doc_id", "held_out")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_index(table(spark, sf_dir, "documents"), tokenizer_json("word_bpe_49k.json"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.capture_digests(warc.assemble(warc.read_warc(spark, path, payloads=False)))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc_id = F.col("doc_id").cast("string")
    altered = F.when(F.crc32(doc_id) % 3 == 0, merkle.leaf_digest(text=merkle.lowered(F.col("text"))))
    manifest = merkle.build(table(spark, sf_dir, "documents"), altered=altered)
    proofs = merkle.verify(manifest, F.coalesce("altered", "leaf"), "doc_id")
    return proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_json("byte_bpe_50k.json"), model, "doc_id")


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_copies(table(spark, sf_dir, "embeddings"))


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, after its code went to the executors."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


OPERATORS = (op1_packing, op2_substrings, op3_simhash, op4_neighbours, op5_suffixes, op6_languages, op7_contexts, op8_decontaminate, op9_token_files, op10_warc, op11_merkle, op12_alignment, op13_near_vectors)
QUERIES = {f.__name__: shipped(f) for f in OPERATORS}

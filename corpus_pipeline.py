"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again, and its
decisions take effect: it drops documents or cuts their texts. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.session import new_folder
from llm import decontaminate, languages, packing, simhash, suffixes
from llm.common import ship, table
from llm.queries import held_out, tokenizer_json

#: A text with this many letters or more whose cosine with every profile is lower is in no known language.
SURE_LETTERS = 200
LEAST_SCORE = 0.2

#: SQL has no tokenizer, no hyperdimensional profiles and no SimHash; tests/llm has a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters, and long ones that are like no language of the corpus."""
    ship(spark)
    profiles = languages.train_profiles(docs, ~held_out(4))
    letters = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\p{L}]", "")) >= SURE_LETTERS
    found = languages.predict_languages(docs.select(F.struct("*").alias("row"), "text"), profiles, "row", "text")
    strange = (F.col("score") < LEAST_SCORE) & letters if profiles.names else F.lit(False)
    alien = F.col("lang_pred") == languages.UNKNOWN if profiles.names else ~F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")
    return found.where(~alien & ~strange).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies."""
    ship(spark)
    return simhash.keep_one(docs)


def carried(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the columns but the text as one, whatever they are called."""
    return docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("row"))


def with_text(docs: DataFrame, made: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` from the row in ``made``, with a new text and its length."""
    new = {"text": F.col(text)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return made.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def earlier_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut what 50 bytes or more have in common with an earlier document. A null text becomes empty."""
    ship(spark)
    return with_text(docs, suffixes.remove_earlier(carried(docs), "row", with_text=True), "kept")


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the passages of benchmark items."""
    ship(spark)
    return with_text(docs, decontaminate.decontaminate(carried(docs), table(spark, sf_dir, "benchmark"), "row"), "clean")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the texts into sequences of 2048 tokens at most; one row per piece."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer_json("byte_bpe_50k.json"))


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", earlier_strings),
    ("benchmark decontamination", benchmark_passages),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        path = new_folder(spark, "pipeline-" + name.replace(" ", "-").lower())
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

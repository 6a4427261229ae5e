"""Token-id shards: frequency-ranked ids in byte-aligned codes with separate control bytes.

A shard file is a row of blocks, each followed by a line feed:

    bytes      content
    4          ``TIB1``
    7 x 8      little-endian: shard, block's place in the shard, documents, ids, distinct
               ids, control bytes, code bytes
    8 x docs   document ids (the smallest long if null)
    8 x docs   ids of each document
    4 x kinds  the block's distinct ids, the most frequent first: rank r stands for entry r
    control    two bits for each rank, four ranks to a byte, lowest first: its bytes less one
    codes      the ranks' 1 to 4 little-endian bytes

The documents are in ascending order of their ids within a shard and from shard to shard. A
block holds about ``BLOCK_BYTES`` of text, and its ranks count all of its ids. Spark's text
writer writes the blocks, so a task that is lost leaves no file behind, and files reach any
store that Spark writes to.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgauge.session import new_folder, stage
from llm.common import chunks
from llm.tokens import encoder

MAGIC = b"TIB1"
HEAD = struct.Struct("<4s7q")
BLOCK_BYTES = 4 << 20
BLOCKS_PER_FILE = 64
END_ID = 1
NO_ID = -(1 << 63)

_CODES = np.arange(256)[:, None] >> np.arange(0, 8, 2) & 3
#: By control byte: the bytes of its four ranks, where they begin, and all of them.
SIZES = (_CODES + 1).astype(np.int64)
BEGINS = np.cumsum(SIZES, axis=1) - SIZES
TOTALS = SIZES.sum(axis=1)
#: By code: which bits of 4 bytes read at once belong to the rank.
MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)[_CODES]


def encode_ranks(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and code bytes of 32-bit ranks."""
    codes = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    quads = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    quads[: len(ranks)] = codes
    control = (quads.reshape(-1, 4) << np.arange(0, 8, 2, dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    split = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control, split[np.arange(4) <= codes[:, None]]


def decode_ranks(control: np.ndarray, codes: np.ndarray, count: int) -> np.ndarray:
    """The ranks, by table lookup on the control bytes."""
    totals = TOTALS[control]
    places = ((np.cumsum(totals) - totals)[:, None] + BEGINS[control]).reshape(-1)[:count]
    padded = np.zeros(len(codes) + 4, dtype=np.uint8)
    padded[: len(codes)] = codes
    at_once = np.ndarray(len(codes) + 1, dtype="<u4", buffer=padded.data, strides=(1,))
    return at_once[places] & MASKS[control].reshape(-1)[:count]


def block_of(shard: int, place: int, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> bytes:
    occurrences = np.bincount(ids) if len(ids) else np.zeros(1, dtype=np.int64)
    kinds = np.flatnonzero(occurrences)
    kinds = kinds[np.argsort(-occurrences[kinds], kind="stable")]
    rank = np.zeros(len(occurrences), dtype=np.uint32)
    rank[kinds] = np.arange(len(kinds), dtype=np.uint32)
    control, codes = encode_ranks(rank[ids])
    names = np.array([NO_ID if d is None else d for d in doc_ids], dtype="<i8")
    head = HEAD.pack(MAGIC, shard, place, len(names), len(ids), len(kinds), len(control), len(codes))
    return b"".join([head, names.tobytes(), counts.astype("<i8").tobytes(), kinds.astype("<u4").tobytes(), control.tobytes(), codes.tobytes()])


def blocks_in(content: bytes):
    """(shard, place, document ids, counts, ids) of each block of a file."""
    at = 0
    while at < len(content):
        magic, shard, place, docs, count, kinds, control, codes = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at += HEAD.size
        names = np.frombuffer(content, "<i8", docs, at)
        counts = np.frombuffer(content, "<i8", docs, at + 8 * docs)
        at += 16 * docs
        table = np.frombuffer(content, "<u4", kinds, at)
        at += 4 * kinds
        ranks = decode_ranks(np.frombuffer(content, np.uint8, control, at), np.frombuffer(content, np.uint8, codes, at + control), count)
        at += control + codes
        if content[at : at + 1] != b"\n":
            raise ValueError(f"the block before byte {at} is not whole")
        at += 1
        yield shard, place, names, counts, table[ranks] if count else np.zeros(0, np.uint32)


def write_token_files(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = END_ID) -> None:
    """Tokenize the documents and write their ids as shards in ascending order of doc_id.

    Null texts have the end id only. Null ids come first; rows with the same id follow one
    another. A document of any length lies in one block.
    """

    def run(batches):
        encode = encoder(tokenizer_json).encode
        shard = TaskContext.get().partitionId()
        for place, (rows, data, offsets) in enumerate(chunks(batches, limit=BLOCK_BYTES)):
            ids, counts = encode(data, offsets)
            ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
            yield pa.RecordBatch.from_arrays([pa.array([block_of(shard, place, rows.column("doc_id").to_pylist(), ids, counts + 1)], pa.binary())], ["block"])

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    blocks = ordered.mapInArrow(run, "block binary")
    blocks.select(F.col("block").cast("string").alias("value")).write.option("maxRecordsPerFile", BLOCKS_PER_FILE).text(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: shard, block and place in it, doc_id, n_tokens, ids_crc32, and the ids if asked for."""

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                for shard, block, names, counts, ids in blocks_in(content.as_py()):
                    ends = np.cumsum(counts)
                    parts = [ids[a:b].astype("<u4") for a, b in zip((ends - counts).tolist(), ends.tolist())]
                    n = len(names)
                    columns = [
                        pa.array(np.full(n, shard)), pa.array(np.full(n, block)), pa.array(np.arange(n)), pa.array(names, mask=names == NO_ID), pa.array(counts),
                        pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                    ]
                    labels = ["shard", "block", "place", "doc_id", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                        labels.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, labels)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, "shard long, block long, place long, doc_id long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))


def token_index(docs: DataFrame, tokenizer_json: str, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the documents' ids, read the files back, and say where each document begins.

    Columns: doc_id, start (ids of all documents before it), n_tokens, ids_crc32. An empty
    table gives no rows. Only the sizes of shards, a row for each file task, meet in one place.
    """
    spark = docs.sparkSession
    path = path or new_folder(spark, "token-files")
    write_token_files(docs, path, tokenizer_json, end_id)
    read = stage(read_token_files(spark, path), "token-index")
    blocks = read.groupBy("shard", "block").agg(F.sum("n_tokens").alias("ids"))
    shards = blocks.groupBy("shard").agg(F.sum("ids").alias("ids"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    shards = shards.select("shard", F.coalesce(F.sum("ids").over(before.orderBy("shard")), none).alias("shard_start"))
    blocks = blocks.select("shard", "block", F.coalesce(F.sum("ids").over(before.partitionBy("shard").orderBy("block")), none).alias("block_start"))
    within = F.coalesce(F.sum("n_tokens").over(before.partitionBy("shard", "block").orderBy("place")), none)
    placed = read.withColumn("within", within).join(blocks, ["shard", "block"]).join(shards, "shard")
    return placed.select("doc_id", (F.col("shard_start") + F.col("block_start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")

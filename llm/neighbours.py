"""Nearest neighbours by inner product over randomly rotated one-bit codes.

A vector is rotated at random and kept as the signs of its components, packed into 64-bit
words, with two scalars: its length, and the inner product of its direction with that of its
code. From these and a query's rotated vector, rounded at random to four bits a component,
bit counts give an unbiased estimate of the inner product and a bound of its error (Gao and
Long, "RaBitQ", 2024). In every shard of the index the best ``k`` by estimate are computed
exactly first; then every vector whose estimate plus bound reaches the k-th of these.

The index holds every vector, in shards of bounded size. Queries are a stated set, in blocks
of bounded size, each of which meets each shard once; every pair of blocks gives ``k`` rows
per query at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.session import stage

SHARD_ROWS = 8192
QUERY_ROWS = 1024
#: The error bound in standard deviations of the estimate, as published.
EPSILON = 1.9
SEED = 7
QUERY_BITS = 4
_SLICE = 64


def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix of a whole number of 64-bit words."""
    padded = -(-dimensions // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((padded, padded)))
    return (q * np.sign(np.diag(r)))[:, :dimensions]


def rows_of(batch: pa.RecordBatch, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of the rows that take part."""
    ids = batch.column("vec_id")
    lists = batch.column("embedding")
    sizes = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fit = np.flatnonzero((sizes == dimensions) & ids.is_valid().to_numpy(zero_copy_only=False))
    flat = lists.take(pa.array(fit)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    vectors = flat.reshape(len(fit), dimensions)
    good = np.isfinite(vectors).all(axis=1) & (vectors != 0).any(axis=1)
    return ids.take(pa.array(fit)).to_numpy(zero_copy_only=False).astype(np.int64)[good], vectors[good]


def codes_of(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs of the rotated vectors, their lengths, and each direction's inner product with its code."""
    turned = vectors @ turn.T
    length = np.linalg.norm(vectors, axis=1)
    packed = np.packbits(turned > 0, axis=1, bitorder="little").view("<u8")
    return packed, length, np.abs(turned).sum(axis=1) / (np.sqrt(turned.shape[1]) * length)


def estimates(packed: np.ndarray, turned: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Inner products of rotated queries with codes (signs over the root of the dimension), from bit counts."""
    padded = turned.shape[1]
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / (2**QUERY_BITS - 1), 1e-300)
    rounded = np.floor((turned - low[:, None]) / step[:, None] + rng.random(turned.shape)).clip(0, 2**QUERY_BITS - 1).astype(np.uint8)
    inner = np.zeros((len(turned), len(packed)), dtype=np.int32)
    for bit in range(QUERY_BITS):
        planes = np.packbits(rounded >> bit & 1, axis=1, bitorder="little").view("<u8")
        for word in range(padded // 64):
            inner += np.bitwise_count(planes[:, word, None] & packed[None, :, word]).astype(np.int32) << bit
    ones = np.bitwise_count(packed).sum(axis=1, dtype=np.int64)
    whole = step * rounded.sum(axis=1, dtype=np.int64) + padded * low
    return (2 * step[:, None] * inner + 2 * low[:, None] * ones[None, :] - whole[:, None]) / np.sqrt(padded)


def best_in_shard(ids: np.ndarray, vectors: np.ndarray, code: tuple, query_ids: np.ndarray, queries: np.ndarray, turn: np.ndarray, k: int, epsilon: float, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and inner product of each query's best ``k`` rows of the shard."""
    packed, length, agree = code
    found = []
    spread = length * np.sqrt(np.maximum(1 - agree**2, 0)) / agree * epsilon / np.sqrt(max(turn.shape[0] - 1, 1))
    rng = np.random.default_rng(seed)
    for low in range(0, len(queries), _SLICE):
        some, names = queries[low : low + _SLICE], query_ids[low : low + _SLICE]
        guess = estimates(packed, some @ turn.T, rng) * (length / agree)
        guess[names[:, None] == ids[None, :]] = -np.inf
        if len(ids) > k:
            first = np.argpartition(-guess, k - 1, axis=1)[:, :k]
            exact = np.stack([(vectors[f] * q).sum(axis=1) for f, q in zip(first, some)])
            exact[np.take_along_axis(guess, first, axis=1) == -np.inf] = -np.inf
            reach = exact.min(axis=1)
        else:
            reach = np.full(len(some), -np.inf)
        bound = np.linalg.norm(some, axis=1)[:, None] * spread[None, :]
        taken = (guess + bound >= reach[:, None]) & (guess > -np.inf)
        if len(ids) > k:
            np.put_along_axis(taken, first, np.take_along_axis(guess, first, axis=1) > -np.inf, axis=1)
        for q in range(len(some)):
            rows = np.flatnonzero(taken[q])
            score = (vectors[rows] * some[q]).sum(axis=1)
            if len(rows) > k:
                kth = -np.partition(-score, k - 1)[k - 1]
                rows, score = rows[score >= kth], score[score >= kth]
            order = np.lexsort((ids[rows], -score))[:k]
            found.append((np.full(len(order), low + q), rows[order], score[order]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, epsilon: float = EPSILON, seed: int = SEED) -> DataFrame:
    """The ``k`` nearest found of every row that ``is_query`` holds for, by largest inner product.

    Columns: query_id, rank (from 1), vec_id, score (the inner product of the vectors given,
    in double precision); ties go to the smaller vec_id. A query's own vec_id is no candidate
    for it. Null vec_ids, vectors that are null or zero or hold a null or a value that is not
    finite, and vectors of another than the most frequent size take no part. Repeated rows
    are candidates, and queries, each for itself. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    read = vectors.select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("is_query"))
    sizes = read.where("embedding IS NOT NULL").groupBy(F.size("embedding").alias("n")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    if common is None or not common.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimensions = int(common.n)
    turn = rotation(dimensions, seed)

    def index(batches):
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            for low in range(0, batch.num_rows, SHARD_ROWS):
                ids, rows = rows_of(batch.slice(low, SHARD_ROWS), dimensions)
                if len(ids):
                    packed, length, agree = codes_of(rows, turn)
                    cells = [[at], [ids.tobytes()], [rows.tobytes()], [packed.tobytes()], [length.tobytes()], [agree.tobytes()]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 0 else pa.binary()) for i, c in enumerate(cells)], ["shard", "ids", "rows", "packed", "length", "agree"])
                    at += 1

    def blocks(batches):
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            for low in range(0, batch.num_rows, QUERY_ROWS):
                ids, rows = rows_of(batch.slice(low, QUERY_ROWS), dimensions)
                if len(ids):
                    yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([ids.tobytes()], pa.binary()), pa.array([rows.tobytes()], pa.binary())], ["block", "query_ids", "queries"])
                    at += 1

    def meet(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, query_ids = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["query_ids"], np.int64)
                rows, queries = (np.frombuffer(row[c]).reshape(-1, dimensions) for c in ("rows", "queries"))
                code = np.frombuffer(row["packed"], "<u8").reshape(len(ids), -1), np.frombuffer(row["length"]), np.frombuffer(row["agree"])
                q, at, score = best_in_shard(ids, rows, code, query_ids, queries, turn, k, epsilon, seed)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), row["block"])), pa.array(q.astype(np.int64)), pa.array(query_ids[q]), pa.array(ids[at]), pa.array(score)], ["block", "place", "query_id", "vec_id", "score"])

    shards = stage(read.select("vec_id", "embedding").mapInArrow(index, "shard long, ids binary, rows binary, packed binary, length binary, agree binary"), "shards")
    asked = stage(read.where("is_query").select("vec_id", "embedding").mapInArrow(blocks, "block long, query_ids binary, queries binary"), "queries")
    everywhere = F.explode(F.array([F.lit(r.shard) for r in shards.select("shard").collect()]).cast("array<long>"))
    met = shards.join(asked.withColumn("shard", everywhere), "shard").select("ids", "rows", "packed", "length", "agree", "block", "query_ids", "queries")
    found = met.mapInArrow(meet, "block long, place long, query_id long, vec_id long, score double")
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

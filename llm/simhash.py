"""SimHash near-duplicates by segment popcounts and a grid join under Manhattan distance.

A fingerprint is embedded as the bit counts of its 32 segments of two bits. Two fingerprints
that differ in k bits have embeddings at a Manhattan distance of k at most, so each half of
the embedding (16 counts) of a linked pair is within some share of k: in one of the halves
the distance is k // 2 at most. Every fingerprint is put into the grid cells around its own
up to half that distance, so such a pair meets in a cell. In a cell the Manhattan distance
of the whole embeddings is tested first, then the bits that differ.

Only distinct fingerprints take part. A cell gives a spanning forest of its links, not all
pairs, which leaves the components as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.session import stage
from llm.common import LOWER, SPACE, chunks, spaced_words
from llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Text whose shingles are hashed at once.
AT_ONCE = 1 << 20
_ODD = np.uint64(0x5555555555555555)
_PAIRS = np.uint64(0x3333333333333333)
_HALF = np.uint64(0xFFFFFFFF)


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """A fingerprint for each text."""
    spaced, starts, ends, at = spaced_words(LOWER[data], offsets, ~SPACE)
    counts = np.diff(at)
    some = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.uint64)
    if not len(some):
        return out
    shingles = np.maximum(counts[some] - shingle + 1, 1)
    firsts = np.cumsum(shingles) - shingles
    word = np.arange(int(shingles.sum())) + np.repeat(at[:-1][some] - firsts, shingles)
    last = np.minimum(word + shingle, np.repeat(at[1:][some], shingles)) - 1
    raw, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    spans = zip(starts[word].tolist(), ends[last].tolist())
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in spans), dtype=np.uint64, count=len(word))
    # bits by shingle, then their sums by text
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.add.reduceat(bits, firsts, axis=0, dtype=np.int32)
    set_bits = (2 * sums > shingles[:, None]).astype(np.uint8)
    out[some] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out


def fingerprints(docs: DataFrame, *columns: str, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """The given columns and fp, the fingerprint of the text as a (signed) long."""

    def run(batches):
        for rows, data, offsets in chunks(batches, limit=AT_ONCE):
            carried = [rows.column(rows.schema.get_field_index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*carried, pa.array(fingerprints_of(data, offsets, shingle).view(np.int64))], [*columns, "fp"])

    schema = docs.select(*columns).schema.add("fp", "long")
    return docs.select(*columns, "text").mapInArrow(run, schema)


def embedding(fps: np.ndarray) -> np.ndarray:
    """The 32 bit counts of the segments, two bits each."""
    return fps - (fps >> np.uint64(1) & _ODD)


def unary(fps: np.ndarray) -> np.ndarray:
    """The embedding with each count in unary, one bit for one and two for two.

    The Manhattan distance of two embeddings is the number of bits in which these differ.
    """
    other = fps >> np.uint64(1)
    return (fps | other) & _ODD | (fps & other & _ODD) << np.uint64(1)


def cells(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For each half: the grid cells within the radius of the fingerprint's own, and whose they are."""
    whole = embedding(fps)
    all_cells, owners = [], []
    for half in (0, 1):
        layer, owner = (whole >> np.uint64(32 * half)) & _HALF, np.arange(len(fps))
        all_cells.append(layer | np.uint64(half << 32))
        owners.append(owner)
        seen = layer.astype(np.uint64) << np.uint64(0), owner
        for _ in range(radius):
            nearer, their = [], []
            for k in range(0, 32, 2):
                count = seen[0] >> np.uint64(k) & np.uint64(3)
                up, down = count < 2, count > 0
                nearer += [seen[0][up] + np.uint64(1 << k), seen[0][down] - np.uint64(1 << k)]
                their += [seen[1][up], seen[1][down]]
            seen = np.concatenate(nearer), np.concatenate(their)
            all_cells.append(seen[0] | np.uint64(half << 32))
            owners.append(seen[1])
    cell, owner = np.concatenate(all_cells), np.concatenate(owners)
    if radius > 1:
        both = np.unique(np.stack([cell, owner.astype(np.uint64)], axis=1), axis=0)
        cell, owner = both[:, 0], both[:, 1].astype(np.int64)
    return cell, owner


def forest(cell: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is linked within each cell; the cells are in order."""
    n = len(cell)
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    whole, left, right = unary(fps), [], []
    active = np.arange(n)
    step = 1
    while True:
        active = active[active + step < n]
        active = active[cell[active] == cell[active + step]]
        if not len(active):
            break
        other = active + step
        near = np.flatnonzero(np.bitwise_count(whole[active] ^ whole[other]) <= max_bits)
        near = near[np.bitwise_count(fps[active[near]] ^ fps[other[near]]) <= max_bits]
        for i, j in zip(active[near].tolist(), other[near].tolist()):
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                left.append(i)
                right.append(j)
        step += 1
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) of distinct fingerprints (column fp) that differ in ``max_bits`` bits at most, without those that others imply."""
    radius = -(-(max_bits // 2) // 2)

    def place(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for low in range(0, len(fps), 2048):
                cell, owner = cells(fps[low : low + 2048], radius)
                yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(fps[low : low + 2048][owner].view(np.int64))], ["cell", "fp"])

    def meet(batches):
        held_cell, held_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def found(cell, fps):
            a, b = forest(cell, fps, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(fps[a].view(np.int64)), pa.array(fps[b].view(np.int64))], ["a", "b"])

        for batch in batches:
            cell = np.concatenate([held_cell, batch.column("cell").to_numpy(zero_copy_only=False)])
            fps = np.concatenate([held_fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            done = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
            if done:
                yield found(cell[:done], fps[:done])
            held_cell, held_fp = cell[done:], fps[done:]
        yield found(held_cell, held_fp)

    placed = distinct.select("fp").mapInArrow(place, "cell long, fp long")
    return placed.repartition("cell").sortWithinPartitions("cell").mapInArrow(meet, "a long, b long")


def groups(prints: DataFrame, key: Column, max_bits: int = MAX_BITS) -> DataFrame:
    """For each distinct fingerprint (fp) the least key of its component (least)."""
    distinct = stage(prints.groupBy("fp").agg(F.min(key).alias("least")), "distinct-fingerprints")
    roots = components(links(distinct, max_bits))
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("least").alias("least"))
    return stage(grouped.drop("least").join(smallest, "root").select("fp", "least"), "components")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable.

    Texts are lower-cased at A-Z; a shingle is ``shingle`` words joined by spaces, repeats
    count, and a shorter text is one shingle. A text without words (null, empty) has the
    fingerprint zero and is linked like any other. Repeated rows give repeated results. A row
    without doc_id is compared too; its component's id is the smallest that is not null. An
    empty table gives no rows.
    """
    prints = stage(fingerprints(docs, "doc_id", shingle=shingle), "fingerprints")
    ids = groups(prints, F.col("doc_id"), max_bits).withColumnRenamed("least", "component_id")
    return prints.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, one for each component: that with the smallest doc_id, the first of repeated rows.

    ``docs`` must give the same rows in the same order whenever it is read, as stored tables do.
    """
    row = "_row" + "_" * max(map(len, docs.columns))
    placed = docs.withColumn(row, F.monotonically_increasing_id())
    prints = stage(fingerprints(placed, "doc_id", row, shingle=shingle), "fingerprints")
    key = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", row)
    kept = groups(prints, key, max_bits).select(F.col(f"least.{row}").alias(row)).distinct()
    return placed.join(kept, row, "left_semi").drop(row)

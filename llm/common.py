"""Helpers of the text operators: chunks of documents, words, hashes and bundles.

A *chunk* is a bounded, document-aligned piece of a task's input, handed to numpy as one
byte buffer with document offsets. A *bundle* is a chunk stored as one compressed row, so
that a task can send the keys of a whole bundle to other tasks and get the answers back in
the same order (`ask`, `answer`, `gather`). Nothing here is specific to an operator.

A text that is null counts as empty. A document always lies in one chunk, however long.
"""

from __future__ import annotations

import ctypes
import importlib.util
import io
import sys
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from flowgauge.session import new_folder, stage

#: Raw text of a bundle. A longer document is a bundle of its own.
BUNDLE_BYTES = 4 << 20
#: Raw text that one of the tasks that compare keys answers for.
PART_BYTES = 16 << 20
#: Words beyond this are hashed one by one.
LONG_WORD = 256
#: White space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower case, in UTF-8.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[np.r_[48:58, 97:123, 128:256]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_SHIPPED: set[str] = set()
#: Where the C library has it.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def ship(spark: SparkSession) -> None:
    """Send the packages that tasks import to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for package in ("flowgauge", "llm"):
            root = Path(importlib.util.find_spec(package).origin).parent
            for source in sorted(root.rglob("*.py")):
                out.write(source, f"{package}/{source.relative_to(root)}")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{new_folder(spark, 'code')}/llm-package.zip")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(bytearray(packed.getvalue()))
    stream.close()
    context.addPyFile(path.toString())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def give_back() -> None:
    """Return freed memory to the system at the end of a task: workers go on to other tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def text_column(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The column as large binary without nulls."""
    values = batch.column(batch.schema.get_field_index(column))
    kind = pa.large_binary() if pa.types.is_binary(values.type) or pa.types.is_large_binary(values.type) else pa.large_string()
    values = values.cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
    return values.cast(pa.large_binary())


def buffer_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a large binary array."""
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BUNDLE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``limit`` bytes of text, their bytes and document offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = text_column(batch, column)
        data, offsets = buffer_of(values)
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            first = last
    give_back()


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes in the set ``inside``, and the first run of each document (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    on = inside[data]
    begins = on.copy()
    begins[1:] &= ~on[:-1]
    ends = on.copy()
    ends[:-1] &= ~on[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = on[edges]
    ends[edges - 1] = on[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def packed_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes between starts and ends (ascending, without overlap) in a row."""
    if not len(starts):
        return data[:0]
    return data[covered(starts, ends, len(data))] if (starts[1:] > ends[:-1]).any() else data[starts[0] : ends[-1]]


def byte_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte strings between starts and ends (ascending, without overlap) as an Arrow array."""
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    packed = np.ascontiguousarray(packed_bytes(data, starts, ends))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i], ..., starts[i] + lengths[i] - 1 for all i in a row."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def words64(data: np.ndarray) -> np.ndarray:
    """At each position the next 8 bytes, first byte lowest; zero bytes follow the end."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data), dtype="<u8", buffer=padded.data, strides=(1,))


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of 64-bit values."""
    x = (x ^ np.uint64(seed & (1 << 64) - 1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i < n."""
    out = np.full(max(n, 1), np.uint64(base & (1 << 64) - 1))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each byte string between starts and ends."""
    lengths = ends - starts
    view = words64(data)
    out = mixed(lengths.astype(np.uint64), seed)
    active, at = np.flatnonzero((lengths > 0) & (lengths <= LONG_WORD)), 0
    while len(active):
        left = lengths[active] - at
        some = view[starts[active] + at]
        cut = left < 8
        some[cut] &= (np.uint64(1) << (8 * left[cut]).astype(np.uint64)) - np.uint64(1)
        out[active] = mixed(out[active] ^ some, seed + 1)
        active, at = active[left > 8], at + 8
    for k in np.flatnonzero(lengths > LONG_WORD).tolist():
        out[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]], seed)
    return out


def window_hashes(hashes: np.ndarray, at: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every ``window`` words of a document in a row; ``at`` has each document's first word."""
    n = len(hashes)
    base = (seed * 2862933555777941757 + 3037000493) & (1 << 64) - 1 | 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers(base, n), dtype=np.uint64)])
    first = ragged(at[:-1], np.maximum(np.diff(at) - window + 1, 0))
    back = powers(pow(base, -1, 1 << 64), n)
    return first, mixed((sums[first + window] - sums[first]) * back[first], seed)


def spaced_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space after each; their starts and ends in it, and each document's first word."""
    starts, ends, at = words(data, offsets, inside)
    lengths = ends - starts
    new_ends = np.cumsum(lengths + 1) - 1
    out = np.full(int(lengths.sum()) + len(lengths), 32, dtype=np.uint8)
    letter = np.ones(len(out), dtype=bool)
    letter[new_ends] = False
    out[letter] = packed_bytes(data, starts, ends)
    return out, new_ends - lengths, new_ends, at


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value."""
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], dtype="<i8").tobytes()
    body = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(1).compress(head + body)


def unsqueeze(value: bytes, *kinds: str) -> list[np.ndarray]:
    """The arrays of `squeeze`, of the given types."""
    raw = zstandard.ZstdDecompressor().decompress(value)
    count = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes = np.frombuffer(raw, "<i8", count, 8)
    at, out = 8 * (count + 1), []
    for size, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(raw, np.dtype(kind), int(size) // np.dtype(kind).itemsize, at))
        at += int(size)
    return out


def planes(values: np.ndarray) -> np.ndarray:
    """Unsigned values with their lowest bytes first, then the next, for the compressor."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)


def unplaned(planed: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planed.reshape(8, -1).T).view("<u8").reshape(-1)


def rising(values: np.ndarray) -> np.ndarray:
    """Ascending unsigned values as planes of their steps."""
    return planes(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unrising(planed: np.ndarray) -> np.ndarray:
    return np.cumsum(unplaned(planed), dtype=np.uint64)


def to_bytes(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_batch(rows)
    return zstandard.ZstdCompressor(1).compress(sink.getvalue())


def from_bytes(value: bytes) -> pa.RecordBatch:
    raw = zstandard.ZstdDecompressor().decompress(value)
    return pa.ipc.open_stream(raw).read_all().combine_chunks().to_batches(max_chunksize=None)[0]


def bundles(docs: DataFrame, *columns: str, limit: int = BUNDLE_BYTES) -> DataFrame:
    """The documents as compressed bundles, written to the shared folder and read back.

    Columns: bundle long, n_bytes long, blob binary. The written copy fixes which document
    lies in which bundle, whatever is computed again after a loss.
    """

    def pack(batches):
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        for rows, data, _ in chunks(batches, limit=limit):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([len(data)], pa.int64()), pa.array([to_bytes(rows)], pa.binary())], ["bundle", "n_bytes", "blob"])
            at += 1

    return stage(docs.select(*columns).mapInArrow(pack, "bundle long, n_bytes long, blob binary"), "bundles")


def part_count(bundled: DataFrame, part_bytes: int = PART_BYTES) -> int:
    """How many parts the keys are dealt to, in proportion to the input."""
    total = bundled.agg(F.sum("n_bytes")).first()[0] or 0
    return max(int(total) // part_bytes, bundled.sparkSession.sparkContext.defaultParallelism)


def opened(rows: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Bundle number, documents, bytes and document offsets of stored bundles."""
    for bundle, blob in zip(rows.column("bundle").to_pylist(), rows.column("blob")):
        docs = from_bytes(blob.as_py())
        yield bundle, docs, *buffer_of(text_column(docs))


def ask(bundled: DataFrame, keys: Callable, *more) -> DataFrame:
    """Send each bundle's keys to parts: ``keys(bundle, docs, data, offsets)`` yields (part, payload).

    Columns: part int, bundle long, payload binary.
    """

    def run(batches):
        for batch in batches:
            for one in opened(batch):
                found = list(keys(*one))
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.int32()), pa.array([one[0]] * len(found), pa.int64()), pa.array([b for _, b in found], pa.binary())], ["part", "bundle", "payload"])

    return bundled.select("bundle", "blob").mapInArrow(run, "part int, bundle long, payload binary")


def answer(asked: DataFrame, parts: int, reply: Callable) -> DataFrame:
    """Bring all payloads of a part together: ``reply(list of (bundle, payload))`` yields (bundle, payload).

    Columns: part int, bundle long, payload binary.
    """

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        order = rows.sort_by("bundle")
        got = list(reply(list(zip(order.column("bundle").to_pylist(), order.column("payload").to_pylist()))))
        return pa.table({"part": pa.array([key[0].as_py()] * len(got), pa.int32()), "bundle": pa.array([b for b, _ in got], pa.int64()), "payload": pa.array([p for _, p in got], pa.binary())})

    return asked.repartition(parts, "part").groupBy("part").applyInArrow(run, "part int, bundle long, payload binary")


def gather(bundled: DataFrame, answers: DataFrame, finish: Callable, schema) -> DataFrame:
    """Each bundle with its answers: ``finish(bundle, docs, data, offsets, {part: payload})`` returns a table.

    A bundle that got no answer is finished too.
    """
    if isinstance(schema, str):
        schema = bundled.sparkSession.createDataFrame([], schema).schema
    empty = to_arrow_schema(schema).empty_table()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        replies = dict(zip(right.column("part").to_pylist(), right.column("payload").to_pylist()))
        made = [finish(*one, replies) for one in opened(left)]
        return pa.concat_tables(made).select(empty.column_names).cast(empty.schema) if made else empty

    return bundled.select("bundle", "blob").groupBy("bundle").cogroup(answers.groupBy("bundle")).applyInArrow(run, schema)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of each 64-bit hash; it does not fall as the hash rises."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in one of the spans."""
    steps = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(steps[:n]) > 0


def per_document(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between the offsets."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[offsets[1:]] - sums[offsets[:-1]]



"""Removal of repeated word sequences with a count-min prefilter.

First every bundle of documents counts its windows of words in a sketch of several rows, each
with its own hash; a counter stops at two. The sketches of all bundles, sent as lists of
counters by slice, are added up. Merged counts are never too low. In a second pass only windows
that the sketch holds to be repeated are grouped exactly, by 128 bits of hash, so none is lost
whatever the sketch's size; a sketch that is too small only leaves more to group.

A bundle sends a window once, with a mark if it has it more than once, so a passage in a
third of all documents costs a key per bundle.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm.common import SPACE, answer, ask, bundles, covered, gather, part_count, part_of, per_document, rising, spaced_words, squeeze, unrising, unsqueeze, window_hashes, word_hashes

WINDOW = 35
ROWS = 2
#: Counters of a sketch row for each word, as long as they fit the largest row.
COUNTERS_PER_WORD = 2
LARGEST_ROW = 1 << 29
SLICE = 1 << 23
SEEDS = (11, 23)


class Windows:
    """The windows of a bundle's documents: their first words and two hashes of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int):
        self.spaced, self.starts, self.ends, self.at = spaced_words(data, offsets, ~SPACE)
        self.hashes = []
        for seed in SEEDS:
            self.first, hashed = window_hashes(word_hashes(self.spaced, self.starts, self.ends, seed), self.at, window, seed)
            self.hashes.append(hashed)


def slots(hashed: np.ndarray, width: int) -> np.ndarray:
    return (hashed & np.uint64(width - 1)).astype(np.int64)


class Sketch:
    """Which counters of the merged sketch stand at two or more."""

    def __init__(self, width: int, slices: dict[int, bytes]):
        self.width, self.slices, self.rows = width, slices, None

    def __getstate__(self):
        return {"width": self.width, "slices": self.slices, "rows": None}

    def repeated(self, hashes: list[np.ndarray]) -> np.ndarray:
        if self.rows is None:
            size = min(SLICE, self.width)
            none = np.zeros(size // 8, dtype=np.uint8)
            each = self.width // size
            parts = [unsqueeze(self.slices[k], "u1")[0] if k in self.slices else none for k in range(ROWS * each)]
            self.rows = [np.concatenate(parts[r * each : (r + 1) * each]) for r in range(ROWS)]
        out = np.ones(len(hashes[0]), dtype=bool)
        for row, hashed in zip(self.rows, hashes, strict=True):
            slot = slots(hashed, self.width)
            out &= (row[slot >> 3] >> (slot & 7) & 1).astype(bool)
        return out


def build_sketch(bundled: DataFrame, words: int, window: int) -> Sketch:
    """The sketch of all windows of the bundles, merged slice by slice."""
    width = min(1 << max(COUNTERS_PER_WORD * words, 8 * 64).bit_length(), LARGEST_ROW)
    size = min(SLICE, width)

    def keys(bundle, docs, data, offsets):
        for row, hashed in enumerate(Windows(data, offsets, window).hashes):
            slot, count = np.unique(slots(hashed, width), return_counts=True)
            bounds = np.searchsorted(slot, np.arange(0, width + 1, size))
            for k, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                if low < high:
                    yield row * (width // size) + k, squeeze(rising(slot[low:high] - k * size), np.packbits(count[low:high] > 1))

    def merge(payloads):
        counters = np.zeros(size, dtype=np.uint8)
        for _, payload in payloads:
            steps, many = unsqueeze(payload, "u1", "u1")
            slot = unrising(steps).astype(np.int64)
            counters[slot] = np.minimum(counters[slot] + 1 + np.unpackbits(many, count=len(slot)), 2)
        yield -1, squeeze(np.packbits(counters > 1, bitorder="little"))

    parts = ROWS * (width // size)
    merged = answer(ask(bundled, keys), parts, merge)
    return Sketch(width, {row.part: bytes(row.payload) for row in merged.toLocalIterator()})


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """Remove every word that lies in a window whose words also begin anywhere else.

    Words are what stands between white space, unchanged. Windows are judged on the input.
    One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 of the kept words
    joined by single spaces (UTF-8, lower-case hex), and with ``with_text`` these words.

    Null, empty and short texts lose nothing. Rows that repeat a doc_id are documents of their
    own, so repeated rows lose all they share. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bundled = bundles(docs, "doc_id", "text")
    parts = part_count(bundled)
    total = bundled.agg({"n_bytes": "sum"}).first()[0] or 0
    sketch = spark.sparkContext.broadcast(build_sketch(bundled, int(total) // 6, window))

    def candidates(windows: Windows):
        """Windows estimated repeated in order of their keys, where each distinct key begins, and the parts' bounds of the keys."""
        some = np.flatnonzero(sketch.value.repeated(windows.hashes))
        one, two = (h[some] for h in windows.hashes)
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        begins = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))[: len(one)])
        bounds = np.searchsorted(part_of(one[begins], parts), np.arange(parts + 1))
        return some[order], one, two, begins, bounds

    def keys(bundle, docs, data, offsets):
        some, one, two, begins, bounds = candidates(Windows(data, offsets, window))
        many = np.diff(begins, append=len(one)) > 1
        for part, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if low < high:
                yield part, squeeze(one[begins[low:high]], two[begins[low:high]], np.packbits(many[low:high]))

    def reply(payloads):
        got = [unsqueeze(p, "<u8", "<u8", "u1") for _, p in payloads]
        sizes = [len(g[0]) for g in got]
        one, two = (np.concatenate([g[k] for g in got]) for k in (0, 1))
        many = np.concatenate([np.unpackbits(g[2], count=n) for g, n in zip(got, sizes)]).astype(bool)
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        begins = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        repeated = np.diff(begins, append=len(a)) > 1
        repeated |= np.logical_or.reduceat(many[order], begins)
        back = np.empty(len(order), dtype=bool)
        back[order] = np.repeat(repeated, np.diff(begins, append=len(a)))
        for (bundle, _), bits in zip(payloads, np.split(back, np.cumsum(sizes)[:-1])):
            yield bundle, squeeze(np.packbits(bits))

    def finish(bundle, docs, data, offsets, replies):
        windows = Windows(data, offsets, window)
        some, one, _, begins, bounds = candidates(windows)
        bits = [np.unpackbits(unsqueeze(replies[p], "u1")[0], count=b - a) for p, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())) if a < b]
        repeated = np.repeat(np.concatenate(bits).astype(bool), np.diff(begins, append=len(one))) if bits else np.zeros(0, dtype=bool)
        first = windows.first[some[repeated]]
        gone = covered(first, first + window, len(windows.starts))
        kept = windows.spaced[np.repeat(~gone, windows.ends - windows.starts + 1)].tobytes()
        sizes = per_document(np.where(gone, 0, windows.ends - windows.starts + 1), windows.at)
        stops = np.cumsum(sizes)
        texts = [kept[a : max(a, b - 1)] for a, b in zip((stops - sizes).tolist(), stops.tolist())]
        columns = {
            "doc_id": docs.column("doc_id"),
            "n_words": pa.array(np.diff(windows.at)),
            "n_removed": pa.array(per_document(gone.astype(np.int64), windows.at)),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
        }
        if with_text:
            columns["kept"] = pa.array(texts, pa.binary()).cast(pa.string())
        return pa.table(columns)

    answers = answer(ask(bundled, keys), parts, reply)
    kind = dict(docs.select("doc_id").dtypes)["doc_id"]
    return gather(bundled, answers, finish, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else ""))

"""Hierarchical multi-length packing of documents into training sequences.

Documents are routed by length to tiers of context size (256 to 2048 tokens by default):
whole windows of the longest tier are cut off first, what remains goes to the smallest tier
that holds it. Every tier is packed into windows of its own size, longest documents first.
The gap that a document leaves in a window is filled with whole documents of shorter tiers,
best fit first, and then with the head of a document that is cut there; without any of a
shorter tier, another of the same tier is cut. Windows are dealt to step groups of equal
size, the longest first, each to the group with the fewest tokens.

Every task packs its own documents and keeps what does not fill a window yet, so nothing is
shuffled. At the end of a task the rest is cut at powers of two, so no sequence is padded
as long as the tiers are powers of two.
"""

from __future__ import annotations

import bisect
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from llm.common import chunks
from llm.tokens import encoder

TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 16 * 2048
END_ID = 1

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, padded_to int, step_group long"

#: A piece that waits: (length, document's place in the pool, first token).
Piece = tuple[int, int, int]


class Pool:
    """Pieces that wait for a window, by tier, each tier sorted by length."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = tiers
        self.waiting: list[list[Piece]] = [[] for _ in tiers]

    def add(self, piece: Piece) -> None:
        if piece[0]:
            bisect.insort(self.waiting[bisect.bisect_left(self.tiers, piece[0])], piece)

    def windows(self, flush: bool) -> Iterator[list[Piece]]:
        """Full windows; with ``flush`` also what is left, cut at powers of two."""
        for t in range(len(self.tiers) - 1, -1, -1):
            while self.waiting[t]:
                window, gap = self.fill(t)
                if not gap:
                    yield window
                elif flush:
                    yield from halves(window)
                else:
                    for piece in window:
                        self.add(piece)
                    break

    def fill(self, t: int) -> tuple[list[Piece], int]:
        """A window of tier ``t`` from the longest piece on, and the gap that nothing could fill."""
        window = [self.waiting[t].pop()]
        gap = self.tiers[t] - window[0][0]
        for shorter in range(min(t, bisect.bisect_left(self.tiers, gap)), -1, -1):
            have = self.waiting[shorter] if shorter < t else []
            while gap and have:
                k = bisect.bisect_right(have, (gap, np.inf)) - 1
                if k < 0:
                    break
                window.append(have.pop(k))
                gap -= window[-1][0]
        for source in range(t + 1):
            while gap and self.waiting[source]:
                have = self.waiting[source]
                k = min(bisect.bisect_left(have, (gap,)), len(have) - 1)
                length, doc, start = have.pop(k)
                used = min(gap, length)
                window.append((used, doc, start))
                gap -= used
                self.add((length - used, doc, start + used))
        return window, gap


def halves(window: list[Piece]) -> Iterator[list[Piece]]:
    """Sequences of the sizes of the powers of two that make up the window's length."""
    left = sum(length for length, _, _ in window)
    window = window[::-1]
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        part = []
        while size:
            length, doc, start = window.pop()
            used = min(size, length)
            part.append((used, doc, start))
            size -= used
            if used < length:
                window.append((length - used, doc, start + used))
        yield part


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """A group for each sequence: the longest first, to the group with the fewest tokens."""
    groups = [(0, g) for g in range(max(1, -(-sum(sizes) // step_tokens)))]
    out = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        tokens, g = heapq.heappop(groups)
        out[k] = g
        heapq.heappush(groups, (tokens + sizes[k], g))
    return out


def pack_documents(docs: DataFrame, tokenizer_json: str, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document and the sequence it lies in.

    ``docs`` needs doc_id (any integer) and text; other columns are not looked at. A
    document's ids are those of the tokenizer without special tokens, and ``end_id``.
    Columns: doc_id, start (the document's ids before the piece), length, ids_crc32,
    doc_tokens, sequence_id, offset (in the sequence), tier (the sequence's length),
    padded_to (its length with padding: the longest tier, or no more if it is a power of
    two), step_group, and with ``with_ids`` the ids.

    Null and empty texts are one piece with the end id alone. Documents of any length are
    cut at the longest tier. Repeated rows and null ids are packed like any other row. An
    empty table gives no rows.
    """
    longest = tiers[-1]

    def run(batches):
        encode = encoder(tokenizer_json).encode
        base = TaskContext.get().partitionId() << 36
        pool, held, names = Pool(tiers), {}, {}
        serial = sequences = groups = 0

        def emit(windows: list[list[Piece]]):
            nonlocal sequences, groups
            sizes = [sum(p[0] for p in w) for w in windows]
            group = step_groups(sizes, step_tokens)
            rows = []
            for w, size, g in zip(windows, sizes, group, strict=True):
                padded = size if size & (size - 1) == 0 else longest
                offset = 0
                for length, doc, start in w:
                    ids = held[doc][start : start + length]
                    name = names[doc]
                    rows.append((name[0], start, length, zlib.crc32(ids.tobytes()), len(held[doc]), base + sequences, offset, size, padded, base + groups + g, ids if with_ids else None))
                    name[1] -= length
                    if not name[1]:
                        del held[doc], names[doc]
                    offset += length
                sequences += 1
            groups += max(group, default=-1) + 1
            columns = list(zip(*rows)) if rows else [()] * 11
            kinds = [pa.int64()] * 7 + [pa.int32()] * 2 + [pa.int64()] + [pa.list_(pa.int32())]
            labels = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "padded_to", "step_group", "ids"]
            n = 11 if with_ids else 10
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:n], kinds[:n])], labels[:n])

        for rows, data, offsets in chunks(batches):
            ids, counts = encode(data, offsets)
            ends = np.cumsum(counts)
            for name, low, high in zip(rows.column("doc_id").to_pylist(), (ends - counts).tolist(), ends.tolist()):
                held[serial] = own = np.append(ids[low:high], np.uint32(end_id)).astype("<u4")
                names[serial] = [name, len(own)]
                whole = len(own) // longest * longest
                for start in range(0, whole, longest):
                    pool.add((longest, serial, start))
                pool.add((len(own) - whole, serial, whole))
                serial += 1
            yield emit(list(pool.windows(False)))
        yield emit(list(pool.windows(True)))

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)

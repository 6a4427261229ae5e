"""Benchmark decontamination with an FM-index of words for every shard of the documents.

A shard is a bounded number of documents. Its text, as numbers of words, is sorted by
suffixes; of the resulting Burrows-Wheeler transform a wavelet matrix answers how often a
word occurs before a place. Test phrases are searched backwards, all at once, and where they
occur follows from every eighth suffix position, reached by steps back through the text.
Spans that overlap or touch are merged.

Only runs of words that the benchmark has, as long as its shortest phrase, can hold an
occurrence; the rest of a shard is left out of its index. Phrases go to the tasks in blocks
of bounded size, and a task takes one block after the other, so there is no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from llm.common import ALNUM, LOWER, byte_array, chunks, covered, per_document, ragged, words

WINDOW = 10
#: Text of the benchmark's items in a block of phrases.
PHRASE_BYTES = 8 << 20
SAMPLE = 8


@dataclass(frozen=True)
class Phrases:
    """A block of distinct phrases: the words, the phrases as rows of word numbers from 1, and the items of each."""

    vocabulary: list[bytes]
    rows: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]


def phrases_of(items: list[tuple[str, str]], window: int) -> Phrases:
    found: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        low = LOWER[data]
        starts, ends, _ = words(low, np.array([0, len(low)]), ALNUM)
        raw = low.tobytes()
        all_words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        for k in range(max(len(all_words) - window + 1, 1) if all_words else 0):
            found.setdefault(tuple(all_words[k : k + window]), set()).add(item)
    number: dict[bytes, int] = {}
    for phrase in found:
        for word in phrase:
            number.setdefault(word, len(number) + 1)
    rows = np.zeros((len(found), window), dtype=np.int64)
    for k, phrase in enumerate(found):
        rows[k, : len(phrase)] = [number[w] for w in phrase]
    return Phrases(list(number), rows, (rows > 0).sum(axis=1), [sorted(s) for s in found.values()])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes by prefix doubling. Zeros end a run; they differ, the first is the least."""
    n = len(text)
    zeros = np.cumsum(text == 0)
    rank = np.unique(np.where(text == 0, zeros, text + n), return_inverse=True)[1]
    step = 1
    while rank.max(initial=0) < n - 1:
        after = np.zeros(n, dtype=np.int64)
        after[: n - step] = rank[step:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1]
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order


class WaveletMatrix:
    """How often a symbol occurs before a place of a sequence."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = []
        for bit in range(max(symbols - 1, 1).bit_length() - 1, -1, -1):
            ones = sequence >> bit & 1
            before = np.concatenate([[0], np.cumsum(ones)])
            self.levels.append((bit, len(sequence) - int(before[-1]), before))
            sequence = np.concatenate([sequence[ones == 0], sequence[ones == 1]])

    def rank(self, symbol: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        moved = [np.zeros(len(symbol), dtype=np.int64), *places]
        for bit, zeros, before in self.levels:
            one = symbol >> bit & 1 == 1
            moved = [np.where(one, zeros + before[p], p - before[p]) for p in moved]
        return [p - moved[0] for p in moved[1:]]


class FMIndex:
    """Search in a text of words (from 1) whose runs end with a zero."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_array(text)
        self.last = text[order - 1]
        self.tree = WaveletMatrix(self.last, symbols)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.sampled = (order % SAMPLE == 0) | (text[order - 1] == 0)
        self.position = order[self.sampled]
        self.sample = np.cumsum(self.sampled) - 1

    def search(self, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase."""
        low, high = np.zeros(len(rows), dtype=np.int64), np.full(len(rows), len(self.last))
        for back in range(rows.shape[1]):
            now = np.flatnonzero((lengths > back) & (low < high))
            symbol = rows[now, lengths[now] - 1 - back]
            a, b = self.tree.rank(symbol, low[now], high[now])
            low[now], high[now] = self.less[symbol] + a, self.less[symbol] + b
        return low, high

    def locate(self, suffixes: np.ndarray) -> np.ndarray:
        """Where suffixes begin."""
        at, steps = suffixes.copy(), np.zeros(len(suffixes), dtype=np.int64)
        walking = np.flatnonzero(~self.sampled[at])
        while len(walking):
            symbol = self.last[at[walking]]
            at[walking] = self.less[symbol] + self.tree.rank(symbol, at[walking])[0]
            steps[walking] += 1
            walking = walking[~self.sampled[at[walking]]]
        return self.position[self.sample[at]] + steps


def occurrences(values: pa.Array, at: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of every phrase found among the words of a shard."""
    none = np.zeros(0, dtype=np.int64)
    if not len(phrases.rows) or not len(values):
        return none, none
    known = pc.index_in(values, pa.array(phrases.vocabulary, values.type)).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    inside = known > 0
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    heads = at[(at > 0) & (at < len(known))]
    begins[heads] = inside[heads]
    ends[heads - 1] = inside[heads - 1]
    first, length = np.flatnonzero(begins), np.flatnonzero(ends) + 1 - np.flatnonzero(begins)
    long = length >= phrases.lengths.min()
    first, length = first[long], length[long]
    if not len(first):
        return none, none
    word = ragged(first, length + 1)
    text = known[np.minimum(word, len(known) - 1)]
    text[np.cumsum(length + 1) - 1] = 0
    index = FMIndex(text, len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.rows, phrases.lengths)
    found = np.maximum(high - low, 0)
    return word[index.locate(ragged(low, found))], np.repeat(np.arange(len(found)), found)


def blocks_of(benchmark: DataFrame, window: int, limit: int = PHRASE_BYTES):
    """Blocks of phrases of about ``limit`` bytes of items, one in memory at a time."""
    held, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        if row.text:
            held.append(("null" if row.item_id is None else str(row.item_id), row.text))
            size += len(row.text)
        if size >= limit:
            yield phrases_of(held, window)
            held, size = [], 0
    yield phrases_of(held, window)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *columns: str, window: int = WINDOW, phrase_bytes: int = PHRASE_BYTES) -> DataFrame:
    """Words of documents that lie in an occurrence of a benchmark phrase.

    A phrase is ``window`` words of an item in a row, or the whole of a shorter one. Words are
    runs of letters, digits and everything beyond ASCII, with A-Z lower-cased. One row for
    each of the documents: the given columns, n_words, n_hit, items (the ids of items with a
    phrase in it, as strings, sorted), spans (of bytes of the text, from the first to the last
    of each run of words that are hit) and clean (the text without them).

    Null and empty texts have no words. Items without words find nothing; a null item_id is
    the item "null", and items that repeat an id are one. Repeated documents give repeated
    rows. Without any benchmark nothing is hit.
    """
    context = docs.sparkSession.sparkContext
    shared = [context.broadcast(block) for block in blocks_of(benchmark, window, phrase_bytes)]

    def run(batches):
        for rows, data, offsets in chunks(batches):
            low = LOWER[data]
            starts, ends, at = words(low, offsets, ALNUM)
            values = byte_array(low, starts, ends)
            doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
            hit, items = np.zeros(len(starts), dtype=bool), [set() for _ in range(rows.num_rows)]
            for block in shared:
                phrases = block.value
                first, phrase = occurrences(values, at, phrases)
                hit |= covered(first, first + phrases.lengths[phrase], len(starts))
                pairs = np.unique(doc[first] * len(phrases.rows) + phrase) if len(first) else first
                for d, p in zip(*(x.tolist() for x in np.divmod(pairs, max(len(phrases.rows), 1)))):
                    items[d].update(phrases.items[p])
            # runs of hit words of a document, as spans of its bytes
            begins, stops = hit.copy(), hit.copy()
            begins[1:] &= ~hit[:-1] | (doc[1:] != doc[:-1])
            stops[:-1] &= ~hit[1:] | (doc[1:] != doc[:-1])
            of = doc[begins]
            span_start, span_end = starts[begins] - offsets[of], ends[stops] - offsets[of]
            bounds = np.searchsorted(of, np.arange(rows.num_rows + 1))
            clean = []
            raw = data.tobytes()
            for d in range(rows.num_rows):
                text = raw[offsets[d] : offsets[d + 1]]
                if bounds[d] < bounds[d + 1]:
                    cut = [0, *np.stack([span_start, span_end], 1)[bounds[d] : bounds[d + 1]].reshape(-1).tolist(), len(text)]
                    text = b"".join(text[a:b] for a, b in zip(cut[::2], cut[1::2]))
                clean.append(text)
            spans = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(span_start, pa.int64()), pa.array(span_end, pa.int64())], ["start", "end"]))
            carried = [rows.column(rows.schema.get_field_index(c)) for c in columns]
            made = [pa.array(np.diff(at)), pa.array(per_document(hit.astype(np.int64), at)), pa.array([sorted(s) for s in items], pa.list_(pa.string())), spans, pa.array(clean, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*carried, *made], [*columns, "n_words", "n_hit", "items", "spans", "clean"])

    span = T.StructType().add("start", "long").add("end", "long")
    schema = docs.select(*columns).schema.add("n_words", "long").add("n_hit", "long").add("items", T.ArrayType(T.StringType())).add("spans", T.ArrayType(span)).add("clean", "string")
    return docs.select(*columns, *([] if "text" in columns else ["text"])).mapInArrow(run, schema)

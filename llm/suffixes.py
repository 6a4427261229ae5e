"""Removal of byte strings that begin in an earlier document too, by sorting suffixes.

Which suffixes can share ``length`` bytes with another is found with anchors: in every window
of ``length`` bytes the 16 bytes with the least hash (of places that tie, as in a run of one letter,
the one whose number mixes to the least, so that few are chosen). Equal windows have equal anchors, so

1. every bundle sends the hashes of its anchors, and learns which occur more than once;
2. for these it sends the text around the anchor, that is the windows that have it, to
   the task that sorts all suffixes with this anchor;
3. there the suffixes are put in order by deep-shallow sorting, up to ``length`` bytes. Those that
   are equal get the smallest document among them, and windows of larger documents are
   reported to their bundles, which remove what these cover.

Hashes only choose candidates; suffixes are compared byte by byte. Within a bundle the same
text is sent once for all its places in a document, and of several documents for the first
only: the others have a smaller one at hand. So the inside of a passage in a third of all documents costs a suffix per bundle. Around
its first and last anchors texts differ from document to document: where an anchor occurs more
than ``HOT_ANCHOR`` times, its windows go one by one to the tasks of a hash of all their bytes,
where equal ones still meet. Anchors that differ and meet in their 40 bits only add candidates.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm.common import answer, ask, bundles, covered, gather, mixed, part_count, part_of, per_document, planes, ragged, squeeze, unplaned, unsqueeze, word_hashes, words64
from llm.deep_shallow import sort_suffixes

LENGTH = 50
ANCHOR = 16
#: Raw text of a bundle, text whose windows are hashed at once, and raw text for which a task sorts suffixes.
BUNDLE_BYTES = 2 << 20
AT_ONCE = 1 << 20
PART_BYTES = 4 << 20
ROWS_AT_ONCE = 1 << 13
#: Occurrences of an anchor from which its windows are dealt one by one.
HOT_ANCHOR = 1 << 16
#: Document of a row without doc_id: after all others.
LAST = (1 << 63) - 1
_LOW = np.uint64((1 << 32) - 1)
#: Places are mixed by an odd factor modulo 2 ** 32, and found again by its inverse.
_MIX = 0x9E3779B1
_UNMIX = np.uint64(pow(_MIX, -1, 1 << 32))
_MIX = np.uint64(_MIX)
_KEY = np.uint64((1 << 40) - 1)


class Anchors:
    """The anchors of a bundle: places, documents, hashes, and the first and last window that has each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        found, doc = [], 0
        while doc < len(offsets) - 1:
            last = int(np.searchsorted(offsets, offsets[doc] + AT_ONCE, side="right")) - 1
            last = min(max(last, doc + 1), len(offsets) - 1)
            # a long document in steps that overlap by what a window needs
            step = AT_ONCE if last == doc + 1 else int(offsets[last] - offsets[doc])
            for low in range(int(offsets[doc]), max(int(offsets[last]) - length + 1, int(offsets[doc]) + 1), max(step, 1)):
                high = min(low + step + length - 1, int(offsets[last]))
                inside = np.array([0, high - low]) if last == doc + 1 else offsets[doc : last + 1] - low
                place, own, hashed, first, end = anchors_of(data[low:high], inside, length)
                found.append((place + low, own + doc, hashed, first + low, end + low))
            doc = last
        none = np.zeros(0, dtype=np.int64)
        columns = [np.concatenate(c) for c in zip(*found)] if found else [none, none, none.astype(np.uint64), none, none]
        self.place, self.doc, self.hash, self.first, self.last = columns


def anchors_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Places, documents, hashes, first and last windows of the anchors of some texts."""
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    window = ragged(offsets[:-1], counts)
    if not len(window):
        return window, window, window.astype(np.uint64), window, window
    n = len(data) - ANCHOR + 1
    view = words64(data)
    hashed = mixed(mixed(view[:n], 5) ^ view[8 : n + 8], 6)
    least = (hashed & ~_LOW) | np.arange(n, dtype=np.uint64) * _MIX & _LOW
    width, span = 1, length - ANCHOR + 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    chosen = ((least[window] & _LOW) * _UNMIX & _LOW).astype(np.int64)
    doc = np.repeat(np.arange(len(counts)), counts)
    heads = np.flatnonzero(np.append(True, (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])))
    place = chosen[heads]
    # anchors have small hashes, so their keys are mixed anew
    return place, doc[heads], mixed(hashed[place], 7), window[heads], window[np.append(heads[1:], len(window)) - 1]


def places_of(data: np.ndarray, first: np.ndarray, size: np.ndarray, number: np.ndarray, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row for each text of a document: which rows these are, how many places each has, and the first bytes of all places in a row.

    Hashes find them, and ``texts(first, size)`` gives the bytes that are compared.
    """
    mark = mixed(word_hashes(data, first, first + size, 13) ^ mixed(number.view(np.uint64), 14), 15)
    _, example, kind = np.unique(mark, return_index=True, return_inverse=True)
    to = example[kind]
    other = np.flatnonzero(to != np.arange(len(first)))
    differ = (number[other] != number[to[other]]) | (size[other] != size[to[other]])
    for low in range(0, len(other), ROWS_AT_ONCE):
        own, its = other[low : low + ROWS_AT_ONCE], to[other[low : low + ROWS_AT_ONCE]]
        differ[low : low + ROWS_AT_ONCE] |= (texts(first[own], size[own]) != texts(first[its], size[its])).any(axis=1)
    to[other[differ]] = other[differ]
    order = np.argsort(to, kind="stable")
    heads = np.flatnonzero(np.append(True, to[order][1:] != to[order][:-1])[: len(order)])
    return to[order][heads], np.diff(heads, append=len(order)), first[order]


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans in order, those that overlap or touch as one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    heads = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    return starts[heads], reach[np.append(heads[1:], len(starts)) - 1]


def doc_numbers(docs: pa.RecordBatch) -> np.ndarray:
    return docs.column("doc_id").cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)


def intervals_of(flags: np.ndarray, rows: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of flagged windows: their row, and the first and last window in it."""
    new = np.append(True, (rows[1:] != rows[:-1]) | (flags[1:] != flags[:-1]))[: len(flags)]
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(flags)) - 1
    on = flags[heads]
    return rows[heads[on]], offset[heads[on]], offset[tails[on]]


def remove_earlier(docs: DataFrame, *columns: str, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """Remove every byte covered by ``length`` bytes that also begin in a document with a smaller doc_id.

    Texts are UTF-8 bytes; overlaps count, windows never cross documents and are judged on
    the input. One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs), kept_sha256 of the remaining bytes (lower-case hex), the further columns
    asked for, and with ``with_text`` kept, the remaining bytes as text without characters
    that were cut apart.

    Null, empty and short texts lose nothing. Rows that repeat a doc_id are the same document:
    neither is earlier. A row without doc_id comes after all others. An empty table gives no rows.
    """
    if length < ANCHOR + 1:
        raise ValueError(f"the length must be more than {ANCHOR}")
    bundled = bundles(docs, "doc_id", "text", *columns, limit=BUNDLE_BYTES)
    parts = part_count(bundled, PART_BYTES)
    width = 2 * length - ANCHOR
    hot_anchor = HOT_ANCHOR

    def grouped(anchors: Anchors):
        """Anchors in order of part and key, where each distinct key begins, and the parts' bounds of the keys."""
        part = part_of(anchors.hash, parts)
        key = part.astype(np.uint64) << np.uint64(40) | anchors.hash & _KEY
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        begins = np.flatnonzero(np.append(True, sorted_key[1:] != sorted_key[:-1])[: len(key)])
        keys = sorted_key[begins]
        return order, begins, keys & _KEY, np.searchsorted(keys >> np.uint64(40), np.arange(parts + 1))

    def ask_keys(bundle, docs, data, offsets):
        order, begins, keys, bounds = grouped(Anchors(data, offsets, length))
        many = np.minimum(np.diff(begins, append=len(order)), 0xFFFF).astype("<u2")
        for part, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if low < high:
                steps = np.diff(keys[low:high], prepend=np.uint64(0))
                yield part, squeeze(planes(steps)[:5], many[low:high])

    def tell_repeated(payloads):
        keys, many = [], []
        for _, payload in payloads:
            steps, counted = unsqueeze(payload, "u1", "<u2")
            steps = np.concatenate([steps, np.zeros(len(steps) // 5 * 3, np.uint8)])
            keys.append(np.cumsum(unplaned(steps), dtype=np.uint64))
            many.append(counted)
        sizes = [len(k) for k in keys]
        every = np.concatenate(keys)
        order = np.argsort(every)
        value = every[order]
        begins = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
        counts = np.diff(begins, append=len(value))
        occurrences = np.add.reduceat(np.concatenate(many)[order], begins, dtype=np.int64)
        back = np.empty(len(order), dtype=np.int8)
        back[order] = np.repeat((occurrences > 1).astype(np.int8) + (occurrences > hot_anchor), counts)
        for (bundle, _), told in zip(payloads, np.split(back, np.cumsum(sizes)[:-1])):
            yield bundle, squeeze(np.packbits(told > 0), np.packbits(told > 1))

    def send_text(bundle, docs, data, offsets, replies):
        anchors = Anchors(data, offsets, length)
        order, begins, keys, bounds = grouped(anchors)
        told = [[np.unpackbits(x, count=b - a) for x in unsqueeze(replies[p], "u1", "u1")] for p, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())) if a < b]
        repeated, hot = (np.repeat(np.concatenate([np.zeros(0, np.uint8), *[t[k] for t in told]]).astype(bool), np.diff(begins, append=len(order))) for k in (0, 1))
        some, hot = order[repeated], hot[repeated]
        first, last, number = anchors.first[some], anchors.last[some], doc_numbers(docs)[anchors.doc[some]]
        # one row for the same text in a document, with all its places
        size, part = last - first + length, part_of(anchors.hash[some], parts)
        rows, many, every = places_of(data, first, size, number, lambda x, n: texts_of(data, x, n))
        begins = np.cumsum(many) - many
        first, last, number, part, hot = first[rows], last[rows], number[rows], part[rows], hot[rows]
        row, shift, size = np.arange(len(rows)), np.zeros(len(rows), np.int64), size[rows]
        if hot.any():
            # every window of a hot anchor for itself
            windows = (last - first + 1)[hot]
            single = ragged(first[hot], windows)
            apart = part_of(mixed(word_hashes(data, single, single + length, 11), 8), parts)
            row = np.concatenate([row[~hot], np.repeat(row[hot], windows)])
            shift = np.concatenate([shift[~hot], single - np.repeat(first[hot], windows)])
            part = np.concatenate([part[~hot], apart])
            size = np.concatenate([size[~hot], np.full(len(single), length)])
        number = number[row]
        text = texts_of(data, first[row] + shift, size)
        # the same text in this bundle: later documents have an earlier one at hand
        kind = np.unique(np.concatenate([text, size[:, None].astype(np.uint8)], axis=1).view(f"V{width + 1}").reshape(-1), return_inverse=True)[1] if len(row) else row
        earliest = np.full(int(kind.max(initial=-1)) + 1, LAST)
        np.minimum.at(earliest, kind, number)
        later = number > earliest[kind]

        def starts_of(chosen):
            counts = many[row[chosen]]
            return every[ragged(begins[row[chosen]], counts)] + np.repeat(shift[chosen], counts), counts

        here = bundle % parts
        out = []
        sent = np.flatnonzero(~later)
        sent = sent[np.argsort(part[sent], kind="stable")]
        cuts = np.searchsorted(part[sent], np.arange(parts + 1))
        for p, (low, high) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            known = np.flatnonzero(later) if p == here else np.zeros(0, dtype=np.int64)
            if low < high or len(known):
                chosen = sent[low:high]
                starts, counts = starts_of(chosen)
                gone, times = starts_of(known)
                gone = merged_spans(gone, gone + np.repeat(size[known], times))
                out.append((p, squeeze(number[chosen], counts.astype(np.uint32), starts.astype(np.uint32), size[chosen].astype(np.uint8), text[chosen], *[x.astype(np.uint32) for x in gone])))
        return pa.table({"part": pa.array([p for p, _ in out], pa.int32()), "bundle": pa.array([bundle] * len(out), pa.int64()), "payload": pa.array([b for _, b in out], pa.binary())})

    def texts_of(data, first, size):
        """The texts as rows of equal width, filled with zeros."""
        out = np.zeros((len(first), width), dtype=np.uint8)
        columns = np.arange(width)
        for low in range(0, len(first), ROWS_AT_ONCE):
            some = slice(low, low + ROWS_AT_ONCE)
            at = np.minimum(first[some, None] + columns, len(data) - 1)
            out[some] = np.where(columns < size[some, None], data[at], np.uint8(0))
        return out

    def sort_part(payloads):
        got = [unsqueeze(p, "<i8", "<u4", "<u4", "u1", "u1", "<u4", "<u4") for _, p in payloads]
        sizes = [len(g[0]) for g in got]
        number, many, first, size = (np.concatenate([g[k] for g in got]).astype(np.int64) for k in (0, 1, 2, 3))
        begins = np.cumsum(many) - many
        text = np.concatenate([g[4] for g in got]).reshape(-1, width)
        later = np.zeros(len(number), dtype=bool)
        flagged = [np.zeros(0, np.int64)] * 3
        if len(number):
            whole = np.concatenate([text, size[:, None].astype(np.uint8)], axis=1).view(f"V{width + 1}").reshape(-1)
            _, example, kind = np.unique(whole, return_index=True, return_inverse=True)
            earliest = np.full(len(example), LAST)
            np.minimum.at(earliest, kind, number)
            later = number > earliest[kind]
            windows = size[example] - length + 1
            rows = np.repeat(np.arange(len(example)), windows)
            offset = np.arange(len(rows)) - np.repeat(np.cumsum(windows) - windows, windows)
            order, same = sort_suffixes(text[example].reshape(-1), rows * width + offset, length)
            heads = np.flatnonzero(~same)
            least = np.minimum.reduceat(earliest[rows[order]], heads)
            flags = np.empty(len(rows), dtype=bool)
            flags[order] = np.repeat(least, np.diff(heads, append=len(order))) < earliest[rows[order]]
            flagged = intervals_of(flags, rows, offset)
        # each kind's flagged runs, for all of its rows that are not flagged as a whole
        bounds = np.searchsorted(flagged[0], np.arange(len(flagged[0]) and int(flagged[0][-1]) + 2))
        at = 0
        for (bundle, _), g, n in zip(payloads, got, sizes):
            own = np.arange(at, at + n)
            at += n
            full = own[later[own]]
            part = own[~later[own]]
            base = first[ragged(begins[full], many[full])]
            starts, ends = [g[5].astype(np.int64), base], [g[6].astype(np.int64), base + np.repeat(size[full], many[full])]
            if len(flagged[0]) and len(part):
                known = part[kind[part] < len(bounds) - 1]
                low, high = bounds[kind[known]], bounds[kind[known] + 1]
                runs, known = ragged(low, high - low), np.repeat(known, high - low)
                times = many[known]
                base = first[ragged(begins[known], times)]
                starts.append(base + np.repeat(flagged[1][runs], times))
                ends.append(base + np.repeat(flagged[2][runs], times) + length)
            starts, ends = merged_spans(np.concatenate(starts), np.concatenate(ends))
            if len(starts):
                yield bundle, squeeze(starts.astype(np.uint32), ends.astype(np.uint32))

    def finish(bundle, docs, data, offsets, replies):
        spans = [unsqueeze(p, "<u4", "<u4") for _, p in sorted(replies.items())]
        starts, ends = (np.concatenate([np.zeros(0, np.int64), *[s[k].astype(np.int64) for s in spans]]) for k in (0, 1))
        gone = covered(starts, ends, len(data))
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        heads = offsets[:-1][offsets[:-1] < len(data)]
        begins[heads] = gone[heads]
        removed = per_document(gone.astype(np.int64), offsets)
        stops = np.cumsum(np.diff(offsets) - removed)
        kept = data[~gone].tobytes()
        texts = [kept[a:b] for a, b in zip(np.append(0, stops[:-1])[: len(stops)].tolist(), stops.tolist())]
        made = {
            "doc_id": docs.column("doc_id"),
            "n_bytes": pa.array(np.diff(offsets)),
            "n_removed": pa.array(removed),
            "n_spans": pa.array(per_document(begins.astype(np.int64), offsets)),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
        } | {c: docs.column(docs.schema.get_field_index(c)) for c in columns}
        if with_text:
            made["kept"] = pa.array([t.decode("utf-8", "ignore") for t in texts], pa.string())
        return pa.table(made)

    repeated = answer(ask(bundled, ask_keys), parts, tell_repeated)
    sent = gather(bundled, repeated, send_text, "part int, bundle long, payload binary")
    found = answer(sent, parts, sort_part)
    schema = docs.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    for field in docs.select(*columns).schema:
        schema = schema.add(field)
    return gather(bundled, found, finish, schema.add("kept", "string") if with_text else schema)

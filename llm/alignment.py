"""Alignment of the tokens of two tokenizers, and how often their ids are linked corpus-wide.

Both tokenizers cover the same bytes, a space and the text. Byte offsets at which a token of
both ends cut the tokens into groups; all pairs of a group's tokens are links.

The groups come from the arrays of token ends by skipping along diagonals. At the places
``i`` and ``j`` of the two arrays, the next 1, 2, 4, ... entries are compared at the current
shift ``j - i``: as long as all are equal, each token is a group of its own with its partner.
At the first difference the irregular group is resolved by advancing whichever array is
behind until both end together, which gives the next shift. Many stretches of a bundle of
texts are followed at once, each from a common end to the next stretch's first.

A task holds a bundle of documents, which is tokenized and aligned once and stored with its
different pairs of ids, each with the number of the bundle's documents that hold it. These
pairs are added up as rows, the sums go back to the bundles that asked, and every document
gets its figures from them. A document longer than a bundle is tokenized in slices, cut before
white space where neither tokenizer joins what lies on both sides.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.session import stage
from llm.common import buffer_of, byte_array, chunks, give_back, ragged, squeeze, unsqueeze
from llm.tokens import AT_ONCE, JOINED, WIDE_SPACE, TextEncoder

#: Text of a bundle, and of a slice of a longer document.
BUNDLE_BYTES = 3 << 20
#: Stretches that are followed at once start so many tokens apart.
STRETCH = 512
#: A group with more links than this counts its different pairs first.
WIDE_GROUP = 1 << 12
#: Pieces of text whose tokens a worker remembers between tasks.
REMEMBERED = 300_000
SPACE_PIECE = "▁"
MARK = SPACE_PIECE.encode()
WHITE = b" \t\n\v\f\r"

_READY: dict[int, PairEncoder] = {}


def encoder(definition: str, model: bytes) -> PairEncoder:
    """The encoder of two tokenizers, one for each worker process."""
    key = hash((definition, model))
    if key not in _READY:
        _READY.clear()
        _READY[key] = PairEncoder(definition, model)
    return _READY[key]


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable Latin-1 stands for itself, the other bytes, in order, for the letters from 256 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


def without_added(definition: str) -> str:
    """The tokenizer with no added tokens: their strings are plain text."""
    return json.dumps(json.loads(definition) | {"added_tokens": []})


class Spelling:
    """The bytes of each id of a vocabulary."""

    def __init__(self, names: list[bytes]):
        self.sizes = np.array([len(b) for b in names], dtype=np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(names), dtype=np.uint8)

    def of(self, ids: np.ndarray) -> bytes:
        return self.flat[ragged(self.begin[ids], self.sizes[ids])].tobytes()


class ByteLevel(TextEncoder):
    """Ids by a byte-level vocabulary."""

    def __init__(self, definition: str):
        super().__init__(without_added(definition))
        if self.kind != "byte":
            raise ValueError("a byte-level vocabulary without normalizer is needed")
        letters = byte_letters()
        names = [b""] * len(self.sizes)
        for token, i in self.tokenizer.get_vocab().items():
            # names of added tokens may use other letters; no text gives them
            names[i] = bytes(letters.get(c, 0) for c in token)
        self.spelling = Spelling(names)


class Pieces:
    """Ids by a sentencepiece model that puts a space in front."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        spelled = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE_PIECE, " ").encode() for i, p in enumerate(names)]
        self.spelling = Spelling(spelled)
        self.space = self.model.piece_to_id(SPACE_PIECE)
        # white space that a piece joins with what stands before it, so that no text may be cut there
        self.joins = {c for b in spelled for before, c in zip(b, b[1:]) if c in WHITE and before not in WHITE}
        self.joins |= {b[1] for b in spelled if len(b) > 1 and b[0] == 32 and b[1] in WHITE and b[1] != 32}

    def ids_of(self, parts: list[bytes]) -> list[list[int]]:
        """The ids of parts of a text that begin with white space, as they are within it."""
        heads = [p[:1] == b" " for p in parts]
        found = self.model.encode([(p[1:] if head else p).decode() for p, head in zip(parts, heads)], num_threads=1) if parts else []
        out = []
        for part, head, ids in zip(parts, heads, found, strict=True):
            if part == b" ":
                ids = [self.space]
            elif not head:
                # the space in front is not there: it is a piece of its own
                ids = ids[1:] if ids[:1] == [self.space] else []
            out.append(ids)
        return out


def apart(part: bytes) -> bool:
    """Whether a part must not be joined with others to one text for the tokenizers."""
    return len(part) > 64 or part[0] not in WHITE or part[-1] in WHITE or (not part.isascii() and (MARK in part or WIDE_SPACE.search(part) is not None))


def ids_by_part(side: ByteLevel | Pieces, parts: list[bytes], joined: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all parts in a row, how many each has, and whether they spell it; the first ``joined`` may be joined."""
    spelling = side.spelling
    groups = [parts[low : min(low + JOINED, joined)] for low in range(0, joined, JOINED)] + [[p] for p in parts[joined:]]
    ids, counts, whole = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
    for low in range(0, len(groups), AT_ONCE):
        some = groups[low : low + AT_ONCE]
        texts = [b"".join(g) for g in some]
        for group, text, found in zip(some, texts, side.ids_of(texts), strict=True):
            made = np.array(found, dtype=np.int32)
            if spelling.of(made) == text:
                ends = np.cumsum(np.fromiter(map(len, group), dtype=np.int64, count=len(group)))
                cuts = np.searchsorted(np.cumsum(spelling.sizes[made]), ends) + 1
                ids.append(made)
                counts.append(np.diff(cuts, prepend=0))
                whole.append(np.ones(len(group), dtype=bool))
                continue
            for part, own in zip(group, side.ids_of(group), strict=True):
                own = np.array(own, dtype=np.int32)
                ids.append(own)
                counts.append(np.array([len(own)]))
                whole.append(np.array([spelling.of(own) == part]))
    return np.concatenate(ids), np.concatenate(counts), np.concatenate(whole)


class PairEncoder:
    """Ids of texts by both tokenizers, run once per distinct part between white space."""

    def __init__(self, definition: str, model: bytes):
        self.first, self.second = ByteLevel(definition), Pieces(model)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.bounds = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.good = np.zeros(0, dtype=bool)

    def parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts, ends, at = self.first.spaced(data, offsets)
        if self.second.joins and len(starts):
            inner = np.ones(len(starts), dtype=bool)
            inner[at[:-1][at[:-1] < at[1:]]] = False
            gone = inner & np.isin(data[starts], list(self.second.joins))
            if gone.any():
                starts = starts[~gone]
                ends = np.append(starts[1:], len(data))
                at = np.searchsorted(starts, offsets)
        return starts, ends, at

    def cuts(self, data: np.ndarray, limit: int) -> list[int]:
        """Where one long text may be cut into slices of about ``limit`` bytes."""
        starts = self.parts(data, np.array([0, len(data)]))[0]
        out = [0]
        while len(data) - out[-1] > limit:
            k = max(int(np.searchsorted(starts, out[-1] + limit, side="right")) - 1, int(np.searchsorted(starts, out[-1], side="right")))
            if k >= len(starts):
                break
            out.append(int(starts[k]))
        return [*out, len(data)]

    def looked_up(self, parts: list[bytes]) -> np.ndarray:
        """The row of each part; what is new is encoded."""
        if len(self.known) > REMEMBERED or len(self.ids[0]) > 8 * REMEMBERED:
            self.forget()
        get = self.known.get
        rows = np.fromiter((get(p, -1) for p in parts), dtype=np.int64, count=len(parts))
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            alone = np.fromiter((apart(parts[k]) for k in missing.tolist()), dtype=bool, count=len(missing))
            missing = missing[np.argsort(alone, kind="stable")]
            new = [parts[k] for k in missing.tolist()]
            joined = int(len(alone) - alone.sum())
            good = np.ones(len(new), dtype=bool)
            first_row = len(self.good)
            for n, side in enumerate((self.first, self.second)):
                ids, counts, whole = ids_by_part(side, new, joined)
                good &= whole
                self.bounds[n] = np.concatenate([self.bounds[n], self.bounds[n][-1] + np.cumsum(counts)])
                self.ids[n] = np.concatenate([self.ids[n], ids])
            self.good = np.concatenate([self.good, good])
            rows[missing] = first_row + np.arange(len(new))
            # of the parts that stand alone the long ones are not remembered
            self.known.update(zip(new[:joined], range(first_row, first_row + joined)))
            self.known.update((p, first_row + k) for k, p in enumerate(new[joined:], joined) if len(p) <= 64)
        return rows

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids by the first and by the second tokenizer, each with the documents' counts, and which documents both cover."""
        starts, ends, at = self.parts(data, offsets)
        found = byte_array(data, starts, ends).dictionary_encode()
        rows = self.looked_up(found.dictionary.to_pylist())
        rows = rows[found.indices.to_numpy(zero_copy_only=False)]
        bad = np.concatenate([[0], np.cumsum(~self.good[rows])])
        good = bad[at[1:]] == bad[at[:-1]]
        kept = np.repeat(good, np.diff(at))
        out: list[np.ndarray] = []
        for ids, bounds in zip(self.ids, self.bounds):
            lengths = np.where(kept, bounds[rows + 1] - bounds[rows], 0)
            sums = np.concatenate([[0], np.cumsum(lengths)])
            out += [ids[ragged(bounds[rows], lengths)], sums[at[1:]] - sums[at[:-1]]]
        return *out, good


def common_ends(a: np.ndarray, b: np.ndarray, stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
    """Which entries of two ascending arrays with the same last entry are in both, by diagonal run skipping."""
    in_a, in_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
    if not len(a):
        return in_a, in_b
    # where stretches begin: behind the first common end from every so many tokens on
    at = np.arange(stretch - 1, len(a), stretch)
    partner = np.zeros(len(at), dtype=np.int64)
    todo = np.arange(len(at))
    while len(todo):
        partner[todo] = np.searchsorted(b, a[at[todo]])
        todo = todo[b[partner[todo]] != a[at[todo]]]
        at[todo] += 1
    at, first = np.unique(at, return_index=True)
    i, j = np.append(0, at + 1), np.append(0, partner[first] + 1)
    stop = np.append(i[1:], len(a))
    run = i < stop
    i, j, stop = i[run], j[run], stop[run]
    probe = np.ones(len(i), dtype=np.int64)
    while len(i):
        n = np.minimum(np.minimum(probe, stop - i), len(b) - j)
        places = ragged(i, n)
        differ = a[places] != b[places + np.repeat(j - i, n)]
        begin = np.cumsum(n) - n
        where = np.flatnonzero(differ)
        # the first difference of each probe, or its length
        k = np.searchsorted(where, begin)
        behind = np.append(where, len(differ) + n[-1])[k] - begin
        equal = np.minimum(behind, n)
        same = ragged(i, equal)
        in_a[same] = True
        in_b[same + np.repeat(j - i, equal)] = True
        i, j = i + equal, j + equal
        probe = np.where(equal == n, 2 * probe, 1)
        # irregular groups: whichever is behind goes on until both end together
        todo = np.flatnonzero(equal < n)
        x, y = i[todo], j[todo]
        while len(todo):
            ends_a, ends_b = a[x], b[y]
            met = ends_a == ends_b
            in_a[x[met]] = True
            in_b[y[met]] = True
            i[todo[met]], j[todo[met]] = x[met] + 1, y[met] + 1
            x, y = (x + (ends_a < ends_b))[~met], (y + (ends_b < ends_a))[~met]
            todo = todo[~met]
        run = i < stop
        i, j, stop, probe = i[run], j[run], stop[run], probe[run]
    return in_a, in_b


def decimals(n: int) -> pa.LargeBinaryArray:
    """The numbers 0 to n - 1 in decimal, first all with a comma behind, then with a bar, then with a semicolon."""
    return pa.array([b"%d%c" % (k, mark) for mark in b",|;" for k in range(n)], pa.large_binary())


class Aligned:
    """Groups and links of the tokens of some texts in a row."""

    def __init__(self, pair: PairEncoder, a: np.ndarray, counts_a: np.ndarray, b: np.ndarray, counts_b: np.ndarray):
        self.a, self.b, self.pair = a, b, pair
        in_a, in_b = common_ends(np.cumsum(pair.first.spelling.sizes[a]), np.cumsum(pair.second.spelling.sizes[b]))
        ends_a, ends_b = np.flatnonzero(in_a) + 1, np.flatnonzero(in_b) + 1
        self.ends_a, self.ends_b = ends_a, ends_b
        self.size_a, self.size_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        #: groups of each text
        self.groups = np.diff(np.searchsorted(ends_a, np.cumsum(counts_a), side="right"), prepend=0)
        self.doc = np.repeat(np.arange(len(counts_a)), self.groups)
        self.links = np.bincount(self.doc, weights=self.size_a * self.size_b, minlength=len(counts_a)).astype(np.int64)

    def pairs(self, kinds: int, span: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of ids linked in each text, as text times ``span`` plus first id times ``kinds`` plus second, and how often."""
        small = self.size_a * self.size_b <= WIDE_GROUP
        begin_a, begin_b = self.ends_a - self.size_a, self.ends_b - self.size_b
        of_group = np.repeat(np.flatnonzero(small), self.size_a[small])
        times = self.size_b[of_group]
        own = self.doc[of_group] * span + self.a[ragged(begin_a[small], self.size_a[small])].astype(np.int64) * kinds
        found = np.repeat(own, times)
        found += self.b[ragged(begin_b[of_group], times)]
        found, many = np.unique(found, return_counts=True)
        if small.all():
            return found, many
        parts = [(found, many)]
        for g in np.flatnonzero(~small).tolist():
            x, n = np.unique(self.a[begin_a[g] : self.ends_a[g]], return_counts=True)
            y, m = np.unique(self.b[begin_b[g] : self.ends_b[g]], return_counts=True)
            parts.append(((self.doc[g] * span + x.astype(np.int64)[:, None] * kinds + y).ravel(), (n[:, None] * m).ravel()))
        return summed(parts)

    def spelled(self, letters: pa.LargeBinaryArray) -> list[bytes]:
        """The groups of each text in decimal."""
        if not len(self.size_a):
            return [b""] * len(self.groups)
        size = self.size_a + self.size_b
        begin = np.cumsum(size) - size
        ids = np.zeros(int(size.sum()), dtype=np.int64)
        ids[ragged(begin, self.size_a)] = self.a
        ids[ragged(begin + self.size_a, self.size_b)] = self.b
        kinds = len(letters) // 3
        ids[begin + self.size_a - 1] += kinds
        ids[begin + size - 1] += 2 * kinds
        raw, lengths = buffer_of(letters.take(pa.array(ids)))
        groups = np.cumsum(self.groups)
        ends = np.where(groups > 0, lengths[np.cumsum(size)[groups - 1]], 0)
        # without the mark behind the last group
        return [raw[s : max(e - 1, s)].tobytes() for s, e in zip([0, *ends[:-1].tolist()], ends.tolist())]


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers with how often each occurs, from parts of such."""
    if len(parts) == 1:
        return parts[0]
    found, place = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
    many = np.zeros(len(found), np.int64)
    np.add.at(many, place, np.concatenate([n for _, n in parts]))
    return found, many


def spaced_texts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that are not empty with a space in front of each."""
    lengths = np.diff(offsets)
    ends = np.cumsum(np.where(lengths > 0, lengths + 1, 0))
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, dtype=np.uint8)
    letter = np.ones(len(out), dtype=bool)
    letter[(ends - lengths - 1)[lengths > 0]] = False
    out[letter] = data
    return out, np.append(0, ends)


def aligned_texts(pair: PairEncoder, data: np.ndarray, offsets: np.ndarray, letters: pa.LargeBinaryArray, limit: int) -> tuple:
    """Counts and digest of each text, and its pairs of ids: n_a, n_b, n_groups, n_links, digests, docs, keys, many."""
    kinds = len(pair.second.spelling.sizes)
    span = len(pair.first.spelling.sizes) * kinds
    data, offsets = spaced_texts(data, offsets)
    if len(offsets) == 2 and len(data) > limit:
        cuts = pair.cuts(data, limit)
    else:
        cuts = [0, len(data)]
    totals = np.zeros((4, len(offsets) - 1), np.int64)
    digests, gathered, whole = [hashlib.sha256() for _ in offsets[1:]], [], np.ones(len(offsets) - 1, dtype=bool)
    for low, high in zip(cuts, cuts[1:]):
        inside = offsets if len(cuts) == 2 else np.array([0, high - low])
        a, counts_a, b, counts_b, good = pair.encode(data[low:high], inside)
        whole &= good
        found = Aligned(pair, a, counts_a, b, counts_b)
        totals += np.stack([counts_a, counts_b, found.groups, found.links])
        for digest, text in zip(digests, found.spelled(letters)):
            if text:
                digest.update(text if low == 0 else b";" + text)
        gathered.append(found.pairs(kinds, span))
    both, many = summed(gathered)
    docs, keys = both // span, both % span
    totals *= whole
    kept = whole[docs]
    spelled = [d.hexdigest() if n else "" for d, n in zip(digests, totals[0].tolist())]
    return totals, spelled, docs[kept], keys[kept], many[kept]


def align(docs: DataFrame, tokenizer_json: str, piece_model: bytes, *columns: str, limit: int = BUNDLE_BYTES) -> DataFrame:
    """The given columns of every row with n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``tokenizer_json`` is a byte-level vocabulary, ``piece_model`` a sentencepiece model; no
    string is a special token. The count of a pair of ids is the number of rows that hold it
    linked. n_best counts the links whose count is the highest of their first id, ties included,
    count_sum adds up the counts of all links. A text that is null, empty, or that the pieces do
    not give back byte for byte has no tokens: zeros, and an empty groups_sha256. Repeated rows
    count each for itself. An empty table gives no rows.
    """
    kept = list(columns)
    source = docs.select(F.struct(*(kept or [F.lit(0).alias("none")])).alias("row"), "text")

    def run(batches) -> Iterator[pa.RecordBatch]:
        pair = encoder(tokenizer_json, piece_model)
        letters = decimals(max(len(pair.first.spelling.sizes), len(pair.second.spelling.sizes)))
        kinds = len(pair.second.spelling.sizes)
        bundle = TaskContext.get().partitionId() << 32
        for rows, data, offsets in chunks(batches, limit=limit):
            totals, digests, own, keys, many = aligned_texts(pair, data, offsets, letters, limit)
            different, place = np.unique(keys, return_inverse=True)
            holders = np.bincount(place, minlength=len(different)).astype(np.int32)
            blob = squeeze(totals, own.astype(np.int32), place.astype(np.int32), many.astype(np.int32))
            cells = [
                pa.array([bundle], pa.int64()), pa.ListArray.from_arrays([0, rows.num_rows], rows.column("row")), pa.array([digests], pa.list_(pa.string())),
                pa.array([blob], pa.binary()), *[pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in (different // kinds, different % kinds, holders)],
            ]
            yield pa.RecordBatch.from_arrays(cells, ["bundle", "rows", "digests", "blob", "firsts", "seconds", "holders"])
            bundle += 1
            give_back()

    schema = T._parse_datatype_string("bundle long, digests array<string>, blob binary, firsts array<int>, seconds array<int>, holders array<int>")
    schema = T.StructType([schema["bundle"], T.StructField("rows", T.ArrayType(source.schema["row"].dataType)), *schema.fields[1:]])
    aligned = stage(source.mapInArrow(run, schema), "aligned-bundles")
    pairs = aligned.select(F.col("bundle").alias("asker"), F.posexplode(F.arrays_zip("firsts", "seconds", "holders")).alias("place", "x"))
    pairs = pairs.select("asker", "place", F.col("x.firsts").alias("a"), F.col("x.seconds").alias("b"), F.col("x.holders").alias("n"))
    counts = stage(pairs.groupBy("a", "b").agg(F.sum("n").alias("n")), "pair-counts")
    # one row for each id of the first vocabulary
    highest = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("most")))
    known = counts.join(highest, "a").select("a", "b", F.when(F.col("n") == F.col("most"), F.col("n")).otherwise(-F.col("n")).alias("signed"))
    answers = pairs.select("asker", "place", "a", "b").join(known, ["a", "b"]).select("asker", "place", "signed")
    out_schema = docs.select(*kept).schema
    for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        out_schema = out_schema.add(name, "long")
    out_schema = out_schema.add("groups_sha256", "string")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        made = []
        # the highest counts of their first id are positive, all others negative
        signed = np.zeros(right.num_rows, np.int64)
        signed[right.column("place").to_numpy()] = right.column("signed").to_numpy()
        for row in range(left.num_rows):
            totals, own, place, many = unsqueeze(left.column("blob")[row].as_py(), "i8", "i4", "i4", "i4")
            totals = totals.reshape(4, -1)
            n, count = totals.shape[1], signed[place]
            many = many.astype(np.int64)
            # sums of whole numbers by text, exact at any size
            steps = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=n))])
            added = [np.concatenate([[0], np.cumsum(x)]) for x in (np.where(count > 0, many, 0), many * np.abs(count))]
            best, total = (x[steps[1:]] - x[steps[:-1]] for x in added)
            rows = left.column("rows")[row].values
            values = [rows.field(c) for c in kept]
            made.append(pa.Table.from_arrays([*values, *[pa.array(x) for x in (*totals, best, total)], left.column("digests")[row].values], names))
        give_back()
        return pa.concat_tables(made)

    names = [f.name for f in out_schema.fields]
    blobs = aligned.select("bundle", "rows", "digests", "blob")
    return blobs.groupBy("bundle").cogroup(answers.groupBy("asker")).applyInArrow(finish, out_schema)

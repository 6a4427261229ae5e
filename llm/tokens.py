"""Token ids of many texts, with the tokenizers library run once per distinct piece.

The two usual kinds of BPE vocabulary treat the parts between white space apart from each
other, so a text's ids are the ids of its pieces in a row:

* byte-level vocabularies that keep white space: a piece is a run of white space and the
  word after it. Beside non-ASCII white space this does not hold, so such a text is one piece;
* vocabularies that drop white space: a piece is a word, with A-Z lower-cased where the
  tokenizer does so itself. Only words of ASCII are lower-cased here: in others the tokenizer
  composes letters and marks first, and an upper-case letter may compose otherwise.

Any other tokenizer gets whole texts. Strings of added tokens in a text are these tokens, as
the library has it by default; a piece that holds one goes to the tokenizer alone, and its
letters keep their case, as these strings are looked for before anything is lower-cased.
A worker remembers the ids of up to ``REMEMBERED``
short pieces between tasks and then forgets those it met once; this saves time only.
"""

from __future__ import annotations

import json
import os
import re
from itertools import compress, repeat

import numpy as np
import pyarrow as pa

from llm.common import LOWER, SPACE, buffer_of, byte_array, ragged, words

REMEMBERED = 750_000
#: Pieces joined to one text for the tokenizer, and such texts given to it at once.
JOINED = 200
AT_ONCE = 32
#: UTF-8 of the white space beyond ASCII (fixed values of the Unicode property White_Space).
WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: A normalizer that composes, makes white space one space, and lower-cases.
COMPOSING = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
LEADS = np.zeros(256, dtype=bool)
LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True

_READY: dict[int, TextEncoder] = {}


def encoder(definition: str) -> TextEncoder:
    """The encoder of a tokenizer's JSON, one for each worker process."""
    key = hash(definition)
    if key not in _READY:
        _READY.clear()
        _READY[key] = TextEncoder(definition)
    return _READY[key]


def holding(pattern: re.Pattern, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which of the pieces in a row hold a match; one across a border marks both, which does no harm."""
    out = np.zeros(len(bounds) - 1, dtype=bool)
    for m in pattern.finditer(data.tobytes()):
        low, high = np.searchsorted(bounds, [m.start(), m.end() - 1], side="right") - 1
        out[low : high + 1] = True
    return out


def sums_of(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place, and in all."""
    out = np.zeros(len(flags) + 1, dtype=np.int32)
    np.cumsum(flags, out=out[1:])
    return out


class TextEncoder:
    def __init__(self, definition: str):
        # a task has one core
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Lowercase

        self.tokenizer = Tokenizer.from_str(definition)
        about = json.loads(definition)
        added = about.get("added_tokens") or []
        contents = sorted({t["content"].encode() for t in added}, key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, contents))) if contents else None
        self.any_case = re.compile(b"|".join(re.escape(c.lower()) for c in contents)) if contents else None
        before, suffix = about.get("pre_tokenizer") or {}, about.get("model", {}).get("end_of_word_suffix")
        plain = about.get("model", {}).get("type") == "BPE" and not about["model"].get("dropout")
        # an added token that reaches beyond its piece needs the whole text
        plain = plain and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") or re.search(r"\s", t["content"]) for t in added)
        self.kind = "text"
        vocabulary = self.tokenizer.get_vocab()
        # bytes of each token of a byte-level vocabulary, and which tokens end a word
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        self.ends_word = np.ones(len(self.sizes), dtype=bool)
        for token, i in vocabulary.items():
            ends = bool(suffix) and token.endswith(suffix)
            self.sizes[i] = len(token) - (len(suffix) if ends else 0)
            self.ends_word[i] = ends or not suffix
        self.joiner = self.tokenizer
        if plain and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not about.get("normalizer"):
            self.kind = "byte"
        elif plain and suffix and before.get("type") == "Sequence" and "Lowercase" in json.dumps(about.get("normalizer")):
            split = before["pretokenizers"][0]
            if split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") and r"\s" in json.dumps(split["pattern"]):
                self.kind = "word"
                if about["normalizer"] == COMPOSING:
                    # pieces that may be joined hold nothing to compose, no added token, and white space only between them, which is dropped
                    self.joiner = Tokenizer(self.tokenizer.model)
                    self.joiner.normalizer, self.joiner.pre_tokenizer = Lowercase(), self.tokenizer.pre_tokenizer
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.bounds = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)
        self.again = np.zeros(0, dtype=bool)

    def forget_rare(self) -> None:
        """Forget the pieces that did not occur again since the last time, or all if too many did."""
        kept = np.flatnonzero(self.again)
        if len(kept) > REMEMBERED // 2:
            self.forget()
            return
        # pieces are known in the order of their rows
        self.known = dict(zip(compress(self.known, self.again.tolist()), range(len(kept))))
        lengths = np.diff(self.bounds)[kept]
        self.ids = self.ids[ragged(self.bounds[kept], lengths)]
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])
        self.again = np.zeros(len(kept), dtype=bool)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents in a row, and how many each has."""
        if self.kind == "word":
            raw, data = data, LOWER[data]
            starts, ends, at = words(data, offsets, ~SPACE)
            wide = sums_of(raw >= 128)
            mixed = wide[ends] > wide[starts]
            kept = ragged(starts[mixed], (ends - starts)[mixed])
            data[kept] = raw[kept]
            for m in self.any_case.finditer(data.tobytes()) if self.any_case else ():
                k = int(np.searchsorted(starts, m.start(), side="right")) - 1
                data[starts[k] : ends[k]] = raw[starts[k] : ends[k]]
            bounds = np.concatenate([[0], np.cumsum(ends - starts)])
            packed = data[~SPACE[data]]
            pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(packed)])
        else:
            starts, ends, at = self.spaced(data, offsets) if self.kind == "byte" else (offsets[:-1], offsets[1:], np.arange(len(offsets)))
            pieces = byte_array(data, starts, ends)
        pieces = pieces.dictionary_encode()
        if len(self.known) > REMEMBERED:
            self.forget_rare()
        first, count = self.looked_up(pieces.dictionary)
        order = pieces.indices.to_numpy(zero_copy_only=False)
        lengths = count[order]
        ids = self.pool[ragged(first[order], lengths)]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        return ids, sums[at[1:]] - sums[at[:-1]]

    def spaced(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of a byte-level vocabulary: white space and the word after it."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        space = SPACE[data]
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        if LEADS[data].any():
            raw = data.tobytes()
            for d in {int(np.searchsorted(offsets, m.start(), side="right")) - 1 for m in WIDE_SPACE.finditer(raw)}:
                begins[offsets[d] : offsets[d + 1]] = False
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[heads] = True
        starts = np.flatnonzero(begins)
        return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)

    def looked_up(self, distinct: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pool has each piece's ids, and how many; only short pieces are remembered."""
        pieces = distinct.to_numpy(zero_copy_only=False).tolist()
        rows = np.fromiter(map(self.known.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        self.again[rows[rows >= 0]] = True
        missing = np.flatnonzero(rows < 0)
        rank = self.ranks(distinct.take(pa.array(missing)))
        missing = missing[np.argsort(rank, kind="stable")]
        joined, short = int((rank == 0).sum()), int((rank < 2).sum())
        new = [pieces[i] for i in missing.tolist()]
        ids, lengths = self.fresh(new, joined)
        bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(lengths)])
        self.pool = np.concatenate([self.ids, ids])
        first = len(self.bounds) - 1
        rows[missing] = first + np.arange(len(missing))
        self.known.update(zip(new[:short], range(first, first + short)))
        self.again = np.concatenate([self.again, np.zeros(short, dtype=bool)])
        self.bounds = bounds[: first + 1 + short]
        self.ids = self.pool[: self.bounds[-1]]
        return bounds[rows], bounds[rows + 1] - bounds[rows]

    def ranks(self, pieces: pa.LargeBinaryArray) -> np.ndarray:
        """0 for a piece that may be joined with others to one text, 1 and 2 for short and long ones that may not."""
        data, bounds = buffer_of(pieces)
        starts, ends = bounds[:-1], bounds[1:]
        if self.kind == "text":
            apart = np.ones(len(starts), dtype=bool)
        elif self.kind == "byte":
            some = ends > starts
            apart = ~some
            apart[some] = ~SPACE[data[starts[some]]] | SPACE[data[ends[some] - 1]]
            apart |= holding(WIDE_SPACE, data, bounds) if LEADS[data].any() else False
        else:
            high = sums_of(data > 0xC9)
            apart = high[ends] > high[starts]
        if self.added is not None:
            apart = apart | holding(self.added, data, bounds)
        return np.where(ends - starts > 64, 2, apart.astype(np.int8))

    def fresh(self, pieces: list[bytes], joined: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that are not known yet, in a row, and how many each has; the first ``joined`` may be joined."""
        between = b"" if self.kind == "byte" else b" "
        groups = [pieces[low : min(low + JOINED, joined)] for low in range(0, joined, JOINED)]
        ids, lengths = [np.zeros(0, dtype=np.uint32)], [np.zeros(0, dtype=np.int64)]
        for low in range(0, len(groups), AT_ONCE):
            some = groups[low : low + AT_ONCE]
            for group, found in zip(some, self.ids_joined([between.join(g) for g in some]), strict=True):
                made = np.array(found, dtype=np.uint32)
                ends = np.cumsum(np.fromiter(map(len, group), dtype=np.int64, count=len(group)))
                sums = np.cumsum(self.sizes[made])
                cuts = np.searchsorted(sums, ends)
                # the tokens spell the pieces, and a token ends with each
                if len(made) and sums[-1] == ends[-1] and (sums[cuts] == ends).all() and self.ends_word[made[cuts]].all():
                    ids.append(made)
                    lengths.append(np.diff(cuts + 1, prepend=0))
                else:
                    self.one_by_one(group, ids, lengths)
        for low in range(joined, len(pieces), JOINED):
            self.one_by_one(pieces[low : low + JOINED], ids, lengths)
        return np.concatenate(ids), np.concatenate(lengths)

    def ids_of(self, texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)]

    def ids_joined(self, texts: list[bytes]) -> list[list[int]]:
        """Ids of texts of pieces that may be joined, without the offsets that nobody asks for."""
        return [e.ids for e in self.joiner.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def one_by_one(self, pieces: list[bytes], ids: list[np.ndarray], lengths: list[np.ndarray]) -> None:
        found = self.ids_of(pieces)
        ids.append(np.fromiter((i for own in found for i in own), dtype=np.uint32))
        lengths.append(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))

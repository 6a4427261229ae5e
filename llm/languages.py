"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram binds its letters: the vector of
the letter k places from its end is rotated k places, and the rotated vectors are multiplied.
A document bundles (adds) the vectors of its n-grams, a language those of its documents, and
a document has the language whose profile has the largest cosine with it.

What is not a letter is one space, letters are lower-cased, and a text is taken to stand
between spaces. A task adds up its own share of the profiles, so only one vector per
language and task is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import chunks

DIMENSIONS = 1024
ORDER = 3
SEED = 20_240_601
#: The code of everything that is not a letter.
GAP = 32
UNKNOWN = "und"
#: Text whose n-grams are counted at once.
AT_ONCE = 2 << 20
_BLOCK = 4096


@dataclass(frozen=True)
class Profiles:
    """Language names, ascending, and a profile of length one for each."""

    names: tuple[str, ...]
    vectors: np.ndarray
    order: int = ORDER
    seed: int = SEED


@cache
def letters() -> np.ndarray:
    """For every code point its lower-case letter, or GAP."""
    out = np.full(0x110000, GAP, dtype=np.uint32)
    for c in (*range(0xD800), *range(0xE000, 0x110000)):
        if (x := chr(c)).isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


@cache
def letter_vector(letter: int, seed: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng([seed, letter]).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and single gaps of the texts, each between two gaps; the document of each; the letters of each document."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype="<u4")
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    code = letters()[points]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(heads))
    gap = code == GAP
    keep = ~gap
    keep[1:] |= ~gap[:-1] & (doc[1:] == doc[:-1])
    counted = np.bincount(doc[~gap], minlength=len(offsets) - 1)
    code, doc = code[keep], doc[keep]
    last = np.append(doc[1:] != doc[:-1], True)[: len(doc)]
    code, doc = code[~last | (code != GAP)], doc[~last | (code != GAP)]
    full = np.flatnonzero(counted)
    begins, ends = np.searchsorted(doc, full), np.searchsorted(doc, full, side="right")
    both = np.stack([begins, ends], axis=1).reshape(-1)
    return np.insert(code, both, GAP), np.insert(doc, both, np.repeat(full, 2)), counted


def ngrams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams as rows of letters; document, n-gram and count of each pair; letters of each document."""
    code, doc, counted = symbols(data, offsets)
    present = np.zeros(0x110000, dtype=bool)
    present[code] = True
    used = np.flatnonzero(present).astype(np.uint32)
    place = np.zeros(0x110000, dtype=np.int64)
    place[used] = np.arange(len(used))
    low, many = place[code], max(len(used), 1)
    n = max(len(code) - order + 1, 0)
    gram = np.zeros(n, dtype=np.int64)
    for k in range(order):
        gram = gram * many + low[k : k + n]
    same = doc[:n] == doc[len(doc) - n :] if n else np.zeros(0, dtype=bool)
    pairs, counts = np.unique(doc[:n][same] * many**order + gram[same], return_counts=True)
    of_doc, of_gram = np.divmod(pairs, many**order)
    kinds, at = np.unique(of_gram, return_inverse=True)
    rows = used[kinds[:, None] // many ** np.arange(order - 1, -1, -1) % many] if len(kinds) else np.zeros((0, order), np.uint32)
    return rows, of_doc, at, counts, counted


def bound(grams: np.ndarray, seed: int, dimensions: int) -> np.ndarray:
    """The vectors of n-grams given as rows of letters."""
    used, at = np.unique(grams, return_inverse=True)
    at = at.reshape(grams.shape)
    plain = np.stack([letter_vector(int(c), seed, dimensions) for c in used])
    out = plain[at[:, -1]]
    for k in range(1, grams.shape[1]):
        out = out * np.roll(plain, k, axis=1)[at[:, -1 - k]]
    return out.astype(np.float32)


def bundled(groups: np.ndarray, grams: np.ndarray, at: np.ndarray, counts: np.ndarray, n: int, seed: int, dimensions: int) -> np.ndarray:
    """Sums of the n-gram vectors by group, a block of n-grams at a time."""
    out = np.zeros((n, dimensions), dtype=np.float64 if n <= 256 else np.float32)
    for low in range(0, len(grams), _BLOCK):
        some = (at >= low) & (at < low + _BLOCK)
        width = min(_BLOCK, len(grams) - low)
        table = np.bincount(groups[some] * width + at[some] - low, weights=counts[some], minlength=n * width).reshape(n, width)
        out += table.astype(np.float32) @ bound(grams[low : low + width], seed, dimensions)
    return out


def train_profiles(docs: DataFrame, learn: Column | None = None, dimensions: int = DIMENSIONS, order: int = ORDER, seed: int = SEED) -> Profiles:
    """Profiles of the languages in column lang, from all rows that ``learn`` holds for.

    Rows without lang or text are not learnt from. The profiles, one vector per language,
    go to the driver. Without any row to learn from there are no profiles.
    """

    def run(batches: Iterable[pa.RecordBatch]):
        sums: dict[str, np.ndarray] = {}
        for rows, data, offsets in chunks(batches, limit=AT_ONCE):
            names, label = np.unique(np.array(rows.column("lang").to_pylist(), dtype=object), return_inverse=True)
            grams, doc, at, counts, _ = ngrams(data, offsets, order)
            if len(grams):
                for name, vector in zip(names, bundled(label[doc], grams, at, counts, len(names), seed, dimensions), strict=True):
                    sums[name] = sums.get(name, 0) + vector.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "vector"])

    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.lit(True) if learn is None else learn))
    shares = known.select("lang", "text").mapInArrow(run, "lang string, vector array<double>")
    sums = shares.select("lang", F.posexplode("vector").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    by_lang: dict[str, np.ndarray] = {}
    for row in sums.collect():
        by_lang.setdefault(row.lang, np.zeros(dimensions))[row.place] = row.value
    names = tuple(sorted(by_lang))
    vectors = np.stack([by_lang[x] / max(np.linalg.norm(by_lang[x]), 1e-300) for x in names]) if names else np.zeros((0, dimensions))
    return Profiles(names, vectors, order, seed)


def predict_languages(docs: DataFrame, profiles: Profiles, *columns: str) -> DataFrame:
    """The given columns of every row with lang_pred and score, the cosine with its profile (0 at least).

    A null text, a text without any letter, and any text if there are no profiles are `und`
    with score 0. Equal cosines go to the first name. The columns must not have these two names.
    """

    def run(batches):
        names = np.array([*profiles.names, UNKNOWN], dtype=object)
        turned = profiles.vectors.T.astype(np.float32)
        for rows, data, offsets in chunks(batches, limit=AT_ONCE):
            grams, doc, at, counts, counted = ngrams(data, offsets, profiles.order)
            n = rows.num_rows
            best, score = np.full(n, len(names) - 1), np.zeros(n)
            if len(grams) and profiles.names:
                vectors = bundled(doc, grams, at, counts, n, profiles.seed, len(turned)).astype(np.float32)
                cosine = (vectors @ turned) / np.maximum(np.linalg.norm(vectors, axis=1), 1e-30)[:, None]
                seen = counted > 0
                best[seen] = cosine[seen].argmax(axis=1)
                score[seen] = np.clip(cosine[seen].max(axis=1), 0, 1)
            carried = [rows.column(rows.schema.get_field_index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*carried, pa.array(names[best], pa.string()), pa.array(score)], [*columns, "lang_pred", "score"])

    read = docs.select(*columns, *([] if "text" in columns else ["text"]))
    schema = docs.select(*columns).schema.add("lang_pred", "string").add("score", "double")
    return read.mapInArrow(run, schema)

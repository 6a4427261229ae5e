"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions, each with a context tree of its own: a node is a context of
0 to ``depth`` bytes before, with the counts of zeros and ones that followed it in the training
texts. A node estimates by Krichevsky and Trofimov; its weighted probability is half its own
estimate of all it has seen and half the product of its children's. With the counts frozen,
a bit's probability mixes the estimates of all depths along its context with the weights that
the training texts gave them. A node that training never visited has nothing to say: the
mixture ends above it. A text ends with the byte FF, which UTF-8 does not have, and begins
after such bytes.

The counts are exact and stay distributed: every context lies in the part of its last two
bytes, or, where a sample of bundles shows that too many keys end in these (``SPLIT_KEYS``), of
its last three, four or five. A bundle sends each part once its distinct contexts with their next
byte and how often its training texts have them: the parts count by these, and later answer
them. Only the sums for contexts of one byte or none, 256 x 256 numbers, and for the split
contexts, at most 255 for each of some 3 x 1024, meet on the driver. The sample decides where a
key is counted and nothing else. Word counts of the unigram model beside it are distributed by
word in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.session import stage
from llm.common import LOWER, SPACE, ask, buffer_of, bundles, byte_array, gather, mixed, opened, part_count, part_of, per_document, planes, rising, squeeze, text_column, unplaned, unrising, unsqueeze, word_hashes, words

DEPTH = 5
END = 0xFF
LEARN = "_learn"
SCORES = {"n_bytes": "long", "n_tokens": "long", "n_known": "long", "train_tokens": "long", "base_score": "double", "score": "double", "bits_per_byte": "double"}
#: Keys, one for each bundle that has it, from which a context is split by its next byte back.
SPLIT_KEYS = 2_000_000
#: A context is split only with more than this share of all keys, so that the split ones stay few.
SPLIT_SHARE = 1024
#: Bundles sampled for it: one of so many, between these bounds.
SAMPLED, SAMPLE_LEAST, SAMPLE_MOST = 32, 4, 16
#: Keys merged or answered at once by a part.
KEYS_AT_ONCE = 4_000_000
_LN_HALF = np.log(0.5)


@dataclass(frozen=True)
class Dealing:
    """Where keys lie: the number of parts, and by depth (2 and up) the contexts that are split, ascending."""

    parts: int
    depth: int
    split: tuple[np.ndarray, ...] = ()

    def owners(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many context bytes decide the part of each key, and the part."""
        part = pair_parts(self.parts)[(key >> np.uint64(8 * (self.depth - 1))).astype(np.int64)]
        owner = np.full(len(key), 2, dtype=np.int8)
        rows = None
        for d, split in enumerate(self.split, 2):
            if not len(split):
                break
            some = key if rows is None else key[rows]
            prefix = some >> np.uint64(8 * (self.depth - d) + 8)
            if d == 2:
                hot = np.zeros(1 << 16, dtype=bool)
                hot[split.astype(np.int64)] = True
                rows = np.flatnonzero(hot[prefix.astype(np.int64)])
            else:
                rows = rows[is_in(prefix, split)]
            longer = key[rows] >> np.uint64(8 * (self.depth - d - 1) + 8)
            part[rows] = part_of(mixed(longer, d + 2), self.parts).astype(np.uint64)
            owner[rows] = d + 1
        return owner, part


@dataclass(frozen=True)
class Shallow:
    """Nodes of contexts of no byte (row 256) and one byte, by decision: the chance of a one, the log weight of the own estimate, visited or not.

    ``split`` has those of the split contexts by depth: numbers (context and decision), ascending, chances and weights.
    """

    one: np.ndarray
    weight: np.ndarray
    visited: np.ndarray
    split: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Model:
    """Counts by part and what the bundles sent (tables in the shared folder), the shallow nodes, and the sizes of the unigram model."""

    counts: DataFrame
    asked: DataFrame
    shallow: Shallow
    dealing: Dealing
    tokens: int
    kinds: int
    texts: int


def stream(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Context and next byte at every place of the texts, as numbers with the nearest context byte first; places of each text."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    filled = np.full(len(data) + n * (depth + 1), END, dtype=np.uint8)
    doc = np.repeat(np.arange(n), sizes)
    filled[np.arange(len(data)) + doc * (depth + 1) + depth] = data
    ends = np.cumsum(sizes + depth + 1)
    place = np.ones(len(filled), dtype=bool)
    for k in range(depth):
        place[ends - sizes - depth - 1 + k] = False
    at = np.flatnonzero(place)
    key = np.zeros(len(at), dtype=np.uint64)
    for k in (*range(1, depth + 1), 0):
        key = key << np.uint64(8) | filled[at - k]
    return key, np.concatenate([[0], np.cumsum(sizes + 1)])


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the place of each key among them; hashed, as keys repeat a lot."""
    code, found = pd.factorize(keys)
    order = np.argsort(found)
    place = np.empty(len(found), dtype=np.int64)
    place[order] = np.arange(len(found))
    return found[order], place[code]


def in_order(keys: np.ndarray, dealing: Dealing) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with their part before them, ascending; of each key the number it was first seen with; and how these are ordered."""
    code, found = pd.factorize(keys)
    dealt = dealt_keys(found, dealing)
    order = np.argsort(dealt)
    return dealt[order], code, order


def pair_parts(parts: int) -> np.ndarray:
    """The part of every two context bytes."""
    return part_of(mixed(np.arange(1 << 16, dtype=np.uint64), 3), parts).astype(np.uint64)


def is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the known, ascending ones."""
    at = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
    return known[at] == values if len(known) else np.zeros(len(values), dtype=bool)


def dealt_keys(key: np.ndarray, dealing: Dealing) -> np.ndarray:
    """Keys with their part before them."""
    return dealing.owners(key)[1] << np.uint64(8 * dealing.depth + 8) | key


def dealing_of(bundled: DataFrame, parts: int, depth: int) -> Dealing:
    """Split contexts by the keys that a sample of the bundles sends."""
    size, n = bundled.agg(F.sum("n_bytes"), F.count("bundle")).first()
    if (size or 0) <= SPLIT_KEYS:
        return Dealing(parts, depth)
    n_sampled = min(n, max(SAMPLE_LEAST, min(SAMPLE_MOST, n // SAMPLED)))
    chosen = [r.bundle for r in bundled.select("bundle").orderBy(F.xxhash64("bundle"), "bundle").limit(n_sampled).collect()]
    least = max(1, SPLIT_KEYS // n // 4)

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in opened(batch):
                key = np.unique(stream(data, offsets, depth)[0])
                levels, prefixes, counts = [np.zeros(1, np.int32)], [np.zeros(1, np.int64)], [np.array([len(key)])]
                for d in range(2, depth):
                    prefix, count = np.unique(key >> np.uint64(8 * (depth - d) + 8), return_counts=True)
                    some = count >= least
                    levels.append(np.full(int(some.sum()), d, dtype=np.int32))
                    prefixes.append(prefix[some].astype(np.int64))
                    counts.append(count[some])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (levels, prefixes, counts)], ["level", "prefix", "n"])

    sample = bundled.where(F.col("bundle").isin(chosen)).select("bundle", "blob").repartition(n_sampled)
    found = sample.mapInArrow(run, "level int, prefix long, n long").groupBy("level", "prefix").agg((F.sum("n") * n / n_sampled).alias("n"))
    rows = found.where((F.col("level") == 0) | (F.col("n") > SPLIT_KEYS)).collect()
    enough = max(SPLIT_KEYS, sum(r.n for r in rows if r.level == 0) / SPLIT_SHARE)
    split: list[np.ndarray] = []
    for d in range(2, depth):
        own = np.sort(np.array([r.prefix for r in rows if r.level == d and r.n > enough], dtype=np.uint64))
        split.append(own[is_in(own >> np.uint64(8), split[-1])] if split else own)
    return Dealing(parts, depth, tuple(split))


def merged_keys(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts, with a bounded number of keys waiting."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def merge() -> tuple[np.ndarray, np.ndarray]:
        key, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return key, np.bincount(at, np.concatenate([c for _, c in held]).astype(float), minlength=len(key)).astype(np.uint64)

    for key, count in parts:
        if held and waiting + len(key) > max(KEYS_AT_ONCE, len(held[0][0])):
            held, waiting = [merge()], 0
        held.append((key, count))
        waiting += len(key)
    return merge()


def together(keys: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The arrays in a row, in groups of about ``KEYS_AT_ONCE`` keys."""
    group: list[np.ndarray] = []
    for some in keys:
        if group and sum(map(len, group)) + len(some) > KEYS_AT_ONCE:
            yield group
            group = []
        group.append(some)
    yield group


def text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the number of each word, and each text's first word."""
    low = LOWER[data]
    starts, ends, at = words(low, offsets, ~SPACE)
    found = byte_array(low, starts, ends).dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False), at


def dealt_words(kinds: pa.Array, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words in the order of their parts, and the parts' bounds."""
    data, bounds = buffer_of(kinds)
    part = part_of(word_hashes(data, bounds[:-1], bounds[1:], 9), parts)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def joined(kinds: pa.Array) -> np.ndarray:
    """Words with a space after each."""
    return np.frombuffer(b"".join(w + b" " for w in kinds.to_pylist()), dtype=np.uint8)


def split(value: np.ndarray) -> pa.Array:
    return pa.array(value.tobytes().split(b" ")[:-1], pa.large_binary())


def train(bundled: DataFrame, parts: int, depth: int = DEPTH) -> Model:
    """Count the texts of the rows of the bundles whose column ``LEARN`` is true."""
    if not 2 <= depth <= 5:
        raise ValueError("the depth must be 2 to 5 bytes")
    dealing = dealing_of(bundled, parts, depth)
    width = np.uint64(8 * depth + 8)

    def keys(bundle, docs, data, offsets):
        learnt = docs.column(LEARN).to_numpy(zero_copy_only=False).astype(bool)
        key, places = stream(data, offsets, depth)
        every, code, order = in_order(key, dealing)
        count = np.bincount(code[np.repeat(learnt, np.diff(places))], minlength=len(order)).astype(np.uint64)[order]
        bounds = np.searchsorted(every >> width, np.arange(parts + 1))
        for part, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if low < high:
                yield part, squeeze(rising(every[low:high]), planes(count[low:high]))
        kinds, number, first = text_words(data, offsets)
        count = np.bincount(number[np.repeat(learnt, np.diff(first))], minlength=len(kinds)).astype(np.uint64)
        order, bounds = dealt_words(kinds, parts)
        for part, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            some = order[low:high]
            if low < high:
                yield parts + part, squeeze(joined(kinds.take(pa.array(some))), planes(count[some]))
        if learnt.any():
            yield 2 * parts, squeeze(np.array([learnt.sum()], dtype=np.int64))

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        part = key[0].as_py()
        payloads = rows.column("payload").to_pylist()
        tokens, kinds = 0, 0
        if part < parts:
            got = ((unrising(k), unplaned(n)) for k, n in (unsqueeze(p, "u1", "u1") for p in payloads))
            key, count = merged_keys((k[n > 0], n[n > 0]) for k, n in got)
            payload = squeeze(rising(key), planes(count))
        elif part < 2 * parts:
            got = [unsqueeze(p, "u1", "u1") for p in payloads]
            number = np.concatenate([unplaned(g[1]) for g in got])
            found = pa.concat_arrays([split(g[0]) for g in got]).filter(pa.array(number > 0)).dictionary_encode()
            count = np.bincount(found.indices.to_numpy(zero_copy_only=False), number[number > 0].astype(float), minlength=len(found.dictionary)).astype(np.uint64)
            tokens, kinds = int(count.sum()), len(count)
            payload = squeeze(joined(found.dictionary), planes(count))
        else:
            tokens = sum(int(unsqueeze(p, "<i8")[0][0]) for p in payloads)
            kinds, payload = int(tokens > 0), squeeze(np.array([tokens], dtype=np.int64))
        return pa.table({"part": pa.array([part], pa.int32()), "tokens": pa.array([tokens], pa.int64()), "kinds": pa.array([kinds], pa.int64()), "payload": pa.array([payload], pa.binary())})

    asked = stage(ask(bundled, keys), "context-keys")
    by_part = asked.select("part", "payload").repartition(2 * parts + 1, "part").groupBy("part")
    counts = stage(by_part.applyInArrow(run, "part int, tokens long, kinds long, payload binary"), "context-counts")
    sizes = counts.agg(F.sum("tokens"), F.sum("kinds"), F.sum(F.when(F.col("part") == 2 * parts, F.col("tokens")))).first()
    return Model(counts, asked, shallow_nodes(counts, dealing), dealing, int(sizes[0] or 0), int(sizes[1] or 0), int(sizes[2] or 0))


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma_of_count(zeros, 0.5) + log_gamma_of_count(ones, 0.5) - np.log(np.pi) - log_gamma_of_count(zeros + ones, 1.0)


@cache
def small_log_gammas(shift: float) -> np.ndarray:
    return log_gamma(np.arange(1 << 12) + shift)


def log_gamma_of_count(count: np.ndarray, shift: float) -> np.ndarray:
    """log_gamma(count + shift); most counts are small and looked up."""
    table = small_log_gammas(shift)
    out = table[np.minimum(count, len(table) - 1).astype(np.int64)]
    large = count >= len(table)
    out[large] = log_gamma(count[large] + shift)
    return out


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series beyond 8, where it is exact to double precision with these terms."""
    x = np.asarray(x, dtype=np.float64)
    shift = np.zeros_like(x)
    for _ in range(8):
        low = x < 8
        shift = np.where(low, shift - np.log(np.where(low, x, 1.0)), shift)
        x = np.where(low, x + 1, x)
    r = 1 / (x * x)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r * (1 / 1188 - r * (691 / 360360)))))) / x
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + series + shift


@dataclass
class Nodes:
    """The visited nodes of one depth and bit: their numbers, ascending, the chance of a one, the log weight of the own estimate and the log weighted probability."""

    number: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weight: np.ndarray
    weighted: np.ndarray


def nodes_of(key: np.ndarray, count: np.ndarray, bit: int, depth: int, least: int) -> list[Nodes]:
    """Nodes of the depths from ``depth`` down to ``least`` for one of the eight bits, from the counts of contexts with their next byte."""
    out: list[Nodes] = []
    for d in range(depth, least - 1, -1):
        cut = key >> np.uint64(8 * (depth - d) + 8)
        byte = key & np.uint64(255)
        number, at = np.unique(cut << np.uint64(bit) | byte >> np.uint64(8 - bit), return_inverse=True)
        is_one = (byte >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
        ones = np.bincount(at, np.where(is_one, count, 0), minlength=len(number))
        zeros = np.bincount(at, np.where(is_one, 0, count), minlength=len(number))
        own = log_estimate(zeros, ones)
        weight, weighted = np.full(len(own), np.inf), own
        if out:
            child = out[-1]
            parent = child.number >> np.uint64(bit + 8) << np.uint64(bit) | child.number & np.uint64((1 << bit) - 1)
            below = np.bincount(np.searchsorted(number, parent), child.weighted, minlength=len(number))
            weight, weighted = own - below, _LN_HALF + np.logaddexp(own, below)
        out.append(Nodes(number, zeros, ones, weight, weighted))
    return out


def part_counts(payload: bytes, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys without their part, ascending, and counts."""
    steps, planed = unsqueeze(payload, "u1", "u1")
    return unrising(steps) & np.uint64((1 << 8 * depth + 8) - 1), unplaned(planed).astype(np.float64)


def parents(number: np.ndarray, bit: int) -> np.ndarray:
    """Context one byte shorter and decision of nodes of one bit."""
    return number >> np.uint64(bit + 8) << np.uint64(8) | np.uint64(1 << bit) | number & np.uint64((1 << bit) - 1)


def shallow_nodes(counts: DataFrame, dealing: Dealing) -> Shallow:
    """Sum up the nodes that parts hold whole for the contexts one byte shorter, down to none."""
    parts, depth = dealing.parts, dealing.depth
    split = [d for d, s in enumerate(dealing.split, 2) if len(s)]
    level = np.uint64(40)

    def run(batches):
        for batch in batches:
            for payload in batch.column("payload"):
                key, count = part_counts(payload.as_py(), depth)
                owner = dealing.owners(key)[0]
                for d in range(2, 3 + len(split)):
                    own = owner == d
                    if not own.any():
                        continue
                    for bit in range(8):
                        top = nodes_of(key[own], count[own], bit, depth, d)[-1]
                        node, at = np.unique(parents(top.number, bit) | np.uint64(d - 1) << level, return_inverse=True)
                        sums = [np.bincount(at, x, minlength=len(node)) for x in (top.zeros, top.ones, top.weighted)]
                        yield pa.RecordBatch.from_arrays([pa.array(node.astype(np.int64)), *map(pa.array, sums)], ["node", "zeros", "ones", "below"])

    grams = counts.where(F.col("part") < parts).select("payload")
    sums = grams.mapInArrow(run, "node long, zeros double, ones double, below double").groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("below"))
    table = sums.toArrow()
    node, *found = (table.column(k).to_numpy() for k in range(4))
    node = node.astype(np.uint64)
    central: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    zeros, ones, below = (np.zeros((257, 256)) for _ in range(3))
    rest = (np.zeros(0, np.uint64), *(np.zeros(0),) * 3)
    for d in [*split[::-1], 1]:
        # sums from the parts, and from the split contexts one byte longer
        here = node >> level == np.uint64(d)
        number, at = np.unique(np.concatenate([node[here] & np.uint64((1 << 40) - 1), rest[0]]), return_inverse=True)
        z, o, w = (np.bincount(at, np.concatenate([x[here], y]), minlength=len(number)) for x, y in zip(found, rest[1:]))
        if d == 1:
            for into, values in zip((zeros, ones, below), (z, o, w)):
                into.reshape(-1)[number.astype(np.int64)] = values
            break
        own = log_estimate(z, o)
        central[d] = (number, (o + 0.5) / (z + o + 1), own - w)
        rest = (number >> np.uint64(16) << np.uint64(8) | number & np.uint64(255), z, o, _LN_HALF + np.logaddexp(own, w))
    own = log_estimate(zeros, ones)
    visited = zeros + ones > 0
    weighted = np.where(visited, _LN_HALF + np.logaddexp(own, below), 0)
    zeros[256], ones[256], below[256] = zeros[:256].sum(axis=0), ones[:256].sum(axis=0), weighted[:256].sum(axis=0)
    own = log_estimate(zeros, ones)
    return Shallow((ones + 0.5) / (zeros + ones + 1), own - below, zeros + ones > 0, central)


def mixture(p: np.ndarray, known: np.ndarray, one: np.ndarray, weight: np.ndarray, visited: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One depth up: the node's own chance where nothing deeper is known, else both by the weight."""
    share = 1 / (1 + np.exp(-np.clip(weight, -700, 700)))
    mixed_p = np.where(known, share * one + (1 - share) * p, one)
    return np.where(visited, mixed_p, p), known | visited


def log_chances(asked: np.ndarray, key: np.ndarray, count: np.ndarray, owner: np.ndarray, shallow: Shallow, depth: int) -> np.ndarray:
    """log10 of the probability of the next byte in its context, for each key asked; ``owner`` has how many bytes decide its part."""
    total = np.zeros(len(asked))
    byte = asked & np.uint64(255)
    nearest = (asked >> np.uint64(8 * depth)).astype(np.int64)
    for bit in range(8):
        p, known = np.full(len(asked), 0.5), np.zeros(len(asked), dtype=bool)
        top = byte >> np.uint64(8 - bit)
        for d, nodes in zip(range(depth, 1, -1), nodes_of(key, count, bit, depth, 2)):
            context = asked >> np.uint64(8 * (depth - d) + 8)
            number = context << np.uint64(bit) | top
            at = np.minimum(np.searchsorted(nodes.number, number), max(len(nodes.number) - 1, 0))
            one, weight, found = (np.zeros(len(asked), dtype=k) for k in (float, float, bool))
            if len(nodes.number):
                one = ((nodes.ones + 0.5) / (nodes.zeros + nodes.ones + 1))[at]
                weight, found = nodes.weight[at], nodes.number[at] == number
            # a part has only some of the contexts under a split one
            apart = np.flatnonzero(owner > d) if d in shallow.split else ()
            if len(apart):
                numbers, ones, weights = shallow.split[d]
                number = context[apart] << np.uint64(8) | np.uint64(1 << bit) | top[apart]
                at = np.minimum(np.searchsorted(numbers, number), max(len(numbers) - 1, 0))
                found[apart] = is_in(number, numbers)
                if len(numbers):
                    one[apart], weight[apart] = ones[at], weights[at]
            p, known = mixture(p, known, one, weight, found)
        decision = (np.uint64(1 << bit) | top).astype(np.int64)
        for row in (nearest, np.full(len(asked), 256)):
            p, known = mixture(p, known, shallow.one[row, decision], shallow.weight[row, decision], shallow.visited[row, decision])
        is_one = byte >> np.uint64(7 - bit) & np.uint64(1)
        total += np.log10(np.where(is_one == 1, p, 1 - p))
    return total


def score_texts(docs: DataFrame, learn: Column, *columns: str, depth: int = DEPTH) -> DataFrame:
    """Score every text by a model of all texts that ``learn`` holds for, and by their word counts.

    Columns: those asked for, n_bytes, n_tokens (words and the end), n_known, train_tokens,
    base_score (log10, add-one unigrams), score (log10 of the model's probability of the text
    and its end) and bits_per_byte (code length per byte, the end included).

    Words are lower-cased at A-Z and stand between white space; the model reads the bytes as
    they are. A null text is empty and has only its end. Where ``learn`` is null a row is not
    learnt from. Without any row to learn from a bit has one bit. Repeated rows count, and are
    scored, each for itself. An empty table gives no rows.
    """
    named = docs.select(*columns, "text", F.coalesce(learn, F.lit(False)).alias(LEARN))
    bundled = bundles(named, *named.columns)
    model = train(bundled, part_count(bundled), depth)
    return score(bundled, model, docs.select(*columns).schema)


def score(bundled: DataFrame, model: Model, carried: T.StructType) -> DataFrame:
    """Scores of the texts of the bundles that the model was made with, with the columns they carry."""
    dealing = model.dealing
    parts, depth = dealing.parts, dealing.depth
    low_bits = np.uint64((1 << 8 * depth + 8) - 1)
    shallow, tokens, kinds_known, texts = model.shallow, model.tokens, model.kinds, model.texts

    def reply(asked: pa.Table, known: pa.Table) -> pa.Table:
        payloads = asked.column("payload").to_pylist()
        have = known.column("payload")[0].as_py() if known.num_rows else None
        out = []
        if payloads and asked.column("part")[0].as_py() < parts:
            key, count = part_counts(have, depth) if have else (np.zeros(0, np.uint64), np.zeros(0))
            for wanted in together(unrising(unsqueeze(p, "u1", "u1")[0]) & low_bits for p in payloads):
                every, at = distinct(np.concatenate(wanted))
                value = log_chances(every, key, count, dealing.owners(every)[0], shallow, depth).astype("<f4")[at]
                out += [squeeze(v) for v in np.split(value, np.cumsum([len(w) for w in wanted])[:-1])]
        elif payloads:
            held, planed = unsqueeze(have, "u1", "u1") if have else (np.zeros(0, np.uint8),) * 2
            lookup, count = split(held), np.append(unplaned(planed), np.uint64(0))
            for payload in payloads:
                at = pc.index_in(split(unsqueeze(payload, "u1", "u1")[0]), lookup).fill_null(len(lookup))
                out.append(squeeze(planes(count[at.to_numpy(zero_copy_only=False)])))
        return pa.table({"part": asked.column("part"), "bundle": asked.column("bundle"), "payload": pa.array(out, pa.binary())})

    def finish(bundle, docs, data, offsets, replies):
        key, places = stream(data, offsets, depth)
        _, code, order = in_order(key, dealing)
        value = np.zeros(len(order))
        value[order] = np.concatenate([np.zeros(0, "<f4"), *[unsqueeze(replies[p], "<f4")[0] for p in sorted(replies) if p < parts]])
        total = per_document(value[code], places)
        kinds, number, first = text_words(data, offsets)
        order, _ = dealt_words(kinds, parts)
        count = np.zeros(len(kinds))
        count[order] = np.concatenate([np.zeros(0, np.uint64), *[unplaned(unsqueeze(replies[p], "u1")[0]) for p in sorted(replies) if p >= parts]])
        seen = count[number]
        n = np.diff(first) + 1
        base = per_document(np.log10(seen + 1), first) + np.log10(texts + 1) - n * np.log10(tokens + kinds_known + 1)
        made = {c: docs.column(docs.schema.get_field_index(c)) for c in carried.names} | {
            "n_bytes": pa.array(np.diff(offsets)),
            "n_tokens": pa.array(n),
            "n_known": pa.array(per_document((seen > 0).astype(np.int64), first) + int(texts > 0)),
            "train_tokens": pa.array(np.full(len(n), tokens)),
            "base_score": pa.array(base),
            "score": pa.array(total),
            "bits_per_byte": pa.array(-total / np.log10(2) / (np.diff(offsets) + 1)),
        }
        return pa.table(made)

    asked = model.asked.where(F.col("part") < 2 * parts).repartition(2 * parts, "part").groupBy("part")
    replies = asked.cogroup(model.counts.select("part", "payload").groupBy("part")).applyInArrow(reply, "part int, bundle long, payload binary")
    schema = T.StructType(list(carried))
    for name, kind in SCORES.items():
        schema = schema.add(name, kind)
    return gather(bundled, replies, finish, schema)

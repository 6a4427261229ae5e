"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def token_ids(texts, file):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
    found = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, 1], dtype="<u4") for e in found]


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


def repeats(docs, window=35):
    """(n_words, n_removed, digest) of each (id, text)."""
    words = [WORD.findall((t or "").encode()) for _, t in docs]
    seen = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = bytearray(len(w))
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = b"\1" * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def earlier(docs, length=50):
    """(n_bytes, n_removed, n_spans, digest) of each (id, text)."""
    order = lambda i: (i is None, i)
    first = {}
    raw = [(i, (t or "").encode()) for i, t in docs]
    for i, b in raw:
        for k in range(len(b) - length + 1):
            piece = b[k : k + length]
            first[piece] = min(first.get(piece, order(i)), order(i), key=lambda x: (x[0], x[1] or 0))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            f = first[b[k : k + length]]
            if (f[0], f[1] or 0) < (i is None, i or 0):
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def fingerprint(text, shingle=4):
    w = WORD.findall((text or "").encode().lower())
    if not w:
        return 0
    pieces = [b" ".join(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))]
    counts = [0] * 64
    for piece in pieces:
        h = xxhash.xxh64_intdigest(piece, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(pieces))


def linked(fingerprints, bits=4):
    """Component number of each fingerprint: the first index reachable."""
    root = list(range(len(fingerprints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fingerprints)):
        for j in range(i):
            if (fingerprints[i] ^ fingerprints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fingerprints))]


def hits(docs, items, window=10):
    """(n_words, n_hit, sorted item ids) of each text."""
    phrases = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            phrases[tuple(w[k : k + window])].add("null" if item is None else str(item))
    sizes = {len(p) for p in phrases}
    out = []
    for text in docs:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if got := phrases.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= got
        out.append((len(w), len(hit), sorted(found)))
    return out


def held(doc_id, folds):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % folds == 2


def unigrams(docs, folds=7):
    """(n_tokens, n_known, train_tokens, base_score) of each (id, text)."""
    words = [WORD.findall((t or "").encode().lower()) for _, t in docs]
    learnt = [w for (i, _), w in zip(docs, words) if not held(i, folds)]
    counts = Counter(x for w in learnt for x in w)
    end = len(learnt)
    total, kinds = sum(counts.values()) + end, len(counts) + (end > 0)
    out = []
    for w in words:
        base = sum(math.log10((c + 1) / (total + kinds + 1)) for c in [*(counts[x] for x in w), end])
        out.append((len(w) + 1, sum(counts[x] > 0 for x in w) + (end > 0), total, base))
    return out


def context_scores(docs, folds=7, depth=4, which=range(40)):
    """log10 of the mixture's probability of the texts with the given places."""

    def decisions(byte):
        return [((1 << j) | byte >> (8 - j), byte >> (7 - j) & 1) for j in range(8)]

    counts = defaultdict(lambda: [0, 0])
    start = b"\xff" * depth
    for i, text in docs:
        if held(i, folds):
            continue
        s = start + (text or "").encode() + b"\xff"
        for k in range(depth, len(s)):
            for node, bit in decisions(s[k]):
                for d in range(depth + 1):
                    counts[s[k - d : k], node][bit] += 1
    own = {k: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1) for k, (a, b) in counts.items()}
    children = defaultdict(list)
    for context, node in counts:
        if context:
            children[context[1:], node].append((context, node))
    weighted, weight = {}, {}
    for k in sorted(counts, key=lambda k: -len(k[0])):
        weighted[k] = own[k]
        if len(k[0]) < depth:
            below = sum(weighted[c] for c in children[k])
            weight[k], weighted[k] = own[k] - below, math.log(0.5) + np.logaddexp(own[k], below)
    out = []
    for n in which:
        s, total = start + (docs[n][1] or "").encode() + b"\xff", 0.0
        for k in range(depth, len(s)):
            for node, bit in decisions(s[k]):
                p = None
                for d in range(depth, -1, -1):
                    key = s[k - d : k], node
                    if key in counts:
                        a, b = counts[key]
                        one = (b + 0.5) / (a + b + 1)
                        share = 1 if p is None else 1 / (1 + math.exp(-max(-700, min(700, weight[key]))))
                        p = share * one + (1 - share) * (p or 0)
                p = 0.5 if p is None else p
                total += math.log10(p if bit else 1 - p)
        out.append(total)
    return out


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle(rows, arity=8):
    """(leaf, subroot, root, proof digest, folded root, verified) of each (doc_id, source, lang, n_chars, text), after the doc_id."""

    def leaf(row):
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tampered(row):
        touched = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None
        return (*row[:4], lower(row[4])) if touched else row

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(*out[-1][k : k + arity]) for k in range(0, len(out[-1]), arity)])
        return out

    def path(tree, k):
        for level in tree[:-1]:
            low = k // arity * arity
            yield level[low:k], level[k + 1 : low + arity]
            k //= arity

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: levels([leaf(r) for r in own[x]]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for n, x in enumerate(langs):
        for k, r in enumerate(own[x]):
            sides = [*path(trees[x], k), *path(top, n)]
            at = leaf(tampered(r))
            for left, right in sides:
                at = digest(*left, at, *right)
            proof = digest(*(d for left, right in sides for d in left + right))
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], proof, at, at == top[-1][0]))
    return out


def cosine_links(rows, threshold=0.9):
    """(vec_id, n_links, component_id, kept) of each (vec_id, vector or None)."""
    sizes = Counter(len(v) for i, v in rows if usable(i, v))
    size = max(sizes, key=lambda n: (sizes[n], n), default=0)
    fit = [k for k, (i, v) in enumerate(rows) if usable(i, v) and len(v) == size]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    if fit:
        x = np.array([rows[k][1] for k in fit], dtype=np.float64)
        x /= np.sqrt((x * x).sum(axis=1))[:, None]
        near = x @ x.T >= threshold
        for a, b in zip(*np.nonzero(np.triu(near, 1))):
            a, b = fit[a], fit[b]
            links[a] += 1
            links[b] += 1
            root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k in fit:
        least[find(k)] = min(least.get(find(k), rows[k][0]), rows[k][0])
    component = [least.get(find(k), i) for k, (i, _) in enumerate(rows)]
    return [(i, n, c, c == i) for (i, _), n, c in zip(rows, links, component)]


def usable(i, v):
    return i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def token_bytes():
    """The bytes of each id of both tokenizers, and functions that give a text's ids."""
    import sentencepiece

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in own)}
    first = {i: bytes(letters[c] for c in token) for token, i in tokenizer.get_vocab().items()}
    second = {}
    for i in range(pieces.get_piece_size()):
        name = pieces.id_to_piece(i)
        second[i] = bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode()
    return first, second, lambda t: tokenizer.encode(t, add_special_tokens=False).ids, pieces.encode


def alignments(docs):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups digest) of each (doc_id, text)."""
    first, second, ids_a, ids_b = token_bytes()
    groups = []
    for _, text in docs:
        groups.append([])
        if not text:
            continue
        whole = " " + text
        a, b = ids_a(whole), ids_b(text)
        if b"".join(first[i] for i in a) != whole.encode() or b"".join(second[i] for i in b) != whole.encode():
            continue
        at = [0, 0]
        run = [[], []]
        a, b = a[::-1], b[::-1]
        while a or b:
            side = 0 if not b or (a and at[0] <= at[1]) else 1
            i = (a, b)[side].pop()
            at[side] += len((first, second)[side][i])
            run[side].append(i)
            if at[0] == at[1]:
                groups[-1].append(run)
                run = [[], []]
    holders = Counter()
    linked = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    for links in linked:
        holders.update(links.keys())
    most = defaultdict(int)
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    out = []
    for (i, _), g, links in zip(docs, groups, linked):
        spelled = ";".join("|".join(",".join(map(str, side)) for side in run) for run in g)
        out.append((
            i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(links.values()), sum(n for p, n in links.items() if holders[p] == most[p[0]]),
            sum(n * holders[p] for p, n in links.items()), hashlib.sha256(spelled.encode()).hexdigest() if g else "",
        ))
    return out

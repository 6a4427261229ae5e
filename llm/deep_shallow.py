"""Deep-shallow sorting of suffixes: multikey quicksort first, blind tries for long common prefixes.

Suffixes are positions of one byte buffer and are compared up to a fixed depth. A symbol of
the multikey quicksort is 8 bytes: large groups are split in three by a pivot and the equal
part goes on at the next symbol; small ones are sorted directly. Groups still equal at the
shallow depth go to blind tries: a node skips the bytes all its suffixes share and branches on
the first byte that differs, without comparing what lies between. The tries of all groups
grow level by level at once.
"""

from __future__ import annotations

import numpy as np

from llm.common import ragged

SHALLOW = 16
SMALL = 1 << 14


def loader(text: np.ndarray):
    """Reads the 8 bytes at positions, the first byte highest. 8 bytes of zero follow the text."""
    padded = np.zeros(len(text) + 8, dtype=np.uint8)
    padded[: len(text)] = text
    view = np.ndarray(len(text) + 1, dtype=">u8", buffer=padded.data, strides=(1,))
    return lambda at: view[at].astype(np.uint64)


def sorted_by(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by several symbols, the first one first, and which entries differ from the one before."""
    sort = np.argsort(keys[0])
    first = keys[0][sort]
    new = np.append(True, first[1:] != first[:-1])
    for key in keys[1:]:
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        own, group = sort[at], np.cumsum(new[at])
        again = np.lexsort((key[own], group))
        sort[at] = own[again]
        value = key[own][again]
        new[at] |= np.append(True, (value[1:] != value[:-1]) | (group[1:] != group[:-1]))
    return sort, new


def multikey_quicksort(load, at: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the suffixes by ``shallow`` bytes; begin and end of the groups that are equal so far."""
    order = np.arange(len(at))
    stack, begins, ends = [(0, len(at), 0)], [], []
    rng = np.random.default_rng(0)
    while stack:
        low, high, depth = stack.pop()
        if high - low < 2:
            continue
        own = order[low:high]
        if depth >= shallow:
            begins.append([low])
            ends.append([high])
        elif high - low <= SMALL:
            sort, new = sorted_by([load(at[own] + d) for d in range(depth, shallow, 8)])
            order[low:high] = own[sort]
            first = np.flatnonzero(new)
            last = np.append(first[1:], high - low)
            many = last - first > 1
            begins.append(first[many] + low)
            ends.append(last[many] + low)
        else:
            key = load(at[own] + depth)
            pivot = np.sort(key[rng.integers(0, len(key), 101)])[50]
            less, same = own[key < pivot], own[key == pivot]
            order[low:high] = np.concatenate([less, same, own[key > pivot]])
            a, b = low + len(less), low + len(less) + len(same)
            stack += [(low, a, depth), (a, b, depth + 8), (b, high, depth)]
    join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
    return order, join(begins), join(ends)


def blind_tries(load, at: np.ndarray, order: np.ndarray, begins: np.ndarray, ends: np.ndarray, depth: int, full: int) -> np.ndarray:
    """Order the groups, in place, up to the full depth; which suffixes equal the one before them."""
    same = np.zeros(len(order), dtype=bool)
    sizes = ends - begins
    place = ragged(begins, sizes)
    deep = np.full(len(begins), depth)
    while len(place):
        first = np.cumsum(sizes) - sizes
        word = load(at[order[place]] + np.repeat(deep, sizes))
        differ = np.bitwise_or.reduceat(word ^ np.repeat(word[first], sizes), first)
        left = full - deep
        short = left < 8
        differ[short] &= ~((np.uint64(1) << (8 * (8 - left[short])).astype(np.uint64)) - np.uint64(1))
        # groups that are equal so far skip a symbol, or are done
        equal = differ == 0
        over = equal & (left <= 8)
        inner = np.ones(len(place), dtype=bool)
        inner[first] = False
        same[place[inner & np.repeat(over, sizes)]] = True
        on = equal & ~over
        next_place, next_sizes, next_deep = [place[np.repeat(on, sizes)]], [sizes[on]], [deep[on] + 8]
        # the others branch on the first byte that differs
        split = ~equal
        member = np.repeat(split, sizes)
        if member.any():
            skip = np.full(int(split.sum()), 7)
            for byte in range(6, -1, -1):
                skip[(differ[split] >> np.uint64(56 - 8 * byte)) > 0] = byte
            sizes_of = sizes[split]
            branch = (word[member] >> np.repeat((56 - 8 * skip).astype(np.uint64), sizes_of)).astype(np.int64) & 255
            key = np.repeat(np.arange(len(sizes_of)), sizes_of) * 256 + branch
            sort = np.argsort(key)
            slots = place[member]
            order[slots] = order[slots[sort]]
            key = key[sort]
            heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            counts = np.diff(heads, append=len(key))
            many = counts > 1
            next_place.append(slots[np.repeat(many, counts)])
            next_sizes.append(counts[many])
            next_deep.append((deep[split] + skip + 1)[key[heads] >> 8][many])
        place, sizes, deep = (np.concatenate(x) for x in (next_place, next_sizes, next_deep))
        done = deep >= full
        if done.any():
            inner = np.ones(len(place), dtype=bool)
            inner[np.cumsum(sizes) - sizes] = False
            at_end = np.repeat(done, sizes)
            same[place[inner & at_end]] = True
            place, sizes, deep = place[~at_end], sizes[~done], deep[~done]
    return same


def sort_suffixes(text: np.ndarray, at: np.ndarray, full: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at the positions by their first ``full`` bytes; which equal the one before them."""
    load = loader(text)
    order, begins, ends = multikey_quicksort(load, at, shallow)
    return order, blind_tries(load, at, order, begins, ends, shallow, full)

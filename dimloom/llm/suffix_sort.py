"""Two-stage suffix sorting of one block of text, in numpy.

Stage one sorts only the suffixes that are smaller than their successors (type S); stage two induces the others (type L) from
them by scanning buckets of equal first bytes in order. Order is by at least the first `depth` bytes; suffixes that agree
beyond stay in any order.
"""

from __future__ import annotations

import numpy as np

#: Codes (byte and type, 9 bits) that make a name of at most 63 bits; a longer stretch is named in steps of _CODES - 1.
_CODES = 7


def suffix_types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its successor; the last one counts as smaller."""
    n = len(t)
    smaller = np.ones(n, bool)
    smaller[:-1] = t[:-1] < t[1:]
    decided = np.ones(n, bool)
    decided[:-1] = t[:-1] != t[1:]
    following = np.where(decided, np.arange(n), n)
    following = np.minimum.accumulate(following[::-1])[::-1]
    return smaller[following]


def _sort_smaller(t: np.ndarray, small: np.ndarray, depth: int) -> np.ndarray:
    """Type S positions in the order of their suffixes.

    A suffix is read as a sequence of stretches from one type S position up to and with the next. With types in the codes (L
    below S) no stretch begins another one, so names in the stretches' order keep the suffixes' order; names are doubled."""
    n = len(t)
    place = np.arange(n)
    since = place - np.maximum.accumulate(np.where(small, place, 0))
    at = np.flatnonzero(small | (since % (_CODES - 1) == 0))
    code = np.concatenate((t.astype(np.int64) * 2 + small + 1, np.zeros(_CODES, np.int64)))
    length = np.append(at[1:], n) - at + 1
    name = np.zeros(len(at), np.int64)
    for j in range(_CODES):
        name = name << 9 | np.where(j < length, code[at + j], 0)
    rank = np.unique(name, return_inverse=True)[1].astype(np.int64)
    held, classes = 1, int(rank.max()) + 1
    while held < depth and classes < len(at):
        ahead = np.zeros(len(at), np.int64)
        ahead[:-held] = rank[held:] + 1
        rank = np.unique(rank * (classes + 1) + ahead, return_inverse=True)[1].astype(np.int64)
        now = int(rank.max()) + 1
        if now == classes:
            break
        held, classes = held * 2, now
    keep = np.flatnonzero(small[at])
    return at[keep[np.argsort(rank[keep], kind="stable")]]


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    """Positions of t (small non-negative integers, the last one 0) in the order of their suffixes, by depth symbols at least."""
    if not len(t):
        return np.empty(0, np.int64)
    small = suffix_types(t)
    first = _sort_smaller(t, small, depth)
    ends = np.searchsorted(t[first], np.arange(int(t.max()) + 2))  # sorted suffixes have sorted first symbols
    waiting: list[list[np.ndarray]] = [[] for _ in range(int(t.max()) + 1)]
    out = []
    for c in range(int(t.max()) + 1):
        larger = waiting[c]
        frontier = np.concatenate(larger) if larger else np.empty(0, np.int64)
        bucket = [frontier]
        while len(frontier):  # runs of c: each step induces the suffixes one symbol longer
            before = frontier[frontier > 0] - 1
            frontier = before[(t[before] == c) & ~small[before]]
            bucket.append(frontier)
        bucket.append(first[ends[c] : ends[c + 1]])
        done = np.concatenate(bucket)
        out.append(done)
        before = done[done > 0] - 1
        before = before[(t[before] > c) & ~small[before]]
        symbol = t[before]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        cuts = np.flatnonzero(np.diff(symbol)) + 1
        for part in np.split(before, cuts):
            if len(part):
                waiting[int(t[part[0]])].append(part)
        waiting[c] = []
    return np.concatenate(out)


def common_prefixes(words: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Common prefixes, in symbols up to `length`, of each suffix in `order` with the one before it (0 for the first).

    words[i] packs the eight symbols from i on; `length` is a multiple of 8."""
    out = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for step in range(0, length, 8):
        a, b = words[order[alive - 1] + step], words[order[alive] + step]
        same = a == b
        lost = alive[~same]
        if len(lost):
            differ = (a ^ b)[~same]
            out[lost] = step + np.argmax((differ[:, None] >> (np.uint64(56) - np.uint64(8) * np.arange(8, dtype=np.uint64))) & np.uint64(255) != 0, axis=1)
        alive = alive[same]
        if not len(alive):
            return out
    out[alive] = length
    return out


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each byte string: the starts whose next `length` bytes also start somewhere else in the strings."""
    t = np.zeros(sum(map(len, texts)) + len(texts), np.int16)
    ends, at = [], 0
    for x in texts:
        t[at : at + len(x)] = np.frombuffer(x, np.uint8)
        t[at : at + len(x)] += 1
        at += len(x) + 1
        ends.append(at - 1)
    if not len(t):
        return []
    end = np.array(ends)
    order = suffix_array(t, length)
    order = order[end[np.searchsorted(end, order)] - order >= length]
    padded = np.concatenate(((t - 1).astype(np.uint8), np.zeros(length + 8, np.uint8))).astype(np.uint64)
    words = np.zeros(len(t) + length, np.uint64)
    for j in range(8):
        words = words << np.uint64(8) | padded[j : j + len(words)]
    whole = length - length % 8
    found = common_prefixes(words, order, whole) >= whole
    if length % 8:
        found[1:] &= words[order[:-1] + length - 8] == words[order[1:] + length - 8]
    hit = found | np.append(found[1:], False)
    starts = np.sort(order[hit])
    cut = np.searchsorted(starts, [0, *(end + 1)])
    first = np.concatenate(([0], end[:-1] + 1))
    return [starts[a:b] - f for a, b, f in zip(cut[:-1], cut[1:], first, strict=True)]

"""Brute-force forms that several tests compare with."""

import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups(ids, linked):
    """Smallest member of each id's component."""
    own = {i: i for i in ids}

    def find(x):
        while own[x] != x:
            x = own[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        own[b] = a
    return {i: find(i) for i in ids}


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_groups(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    near = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), c) for i, c in groups(ids, near).items()}


def check_packed(rows, cap):
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap
    return len(seqs)

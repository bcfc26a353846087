import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from dimloom.llm import suffix_dedup
from dimloom.llm.suffix_sort import repeated_starts, suffix_array


def brute(rows, length):
    """The contract, window by window."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[j : j + length] for _, b in raw for j in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone[j : j + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("letters", ["a", "ab", "abcdef"])
def test_suffix_array_equals_sorting(letters):
    rng = random.Random(letters)
    for _ in range(200):
        s = "".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) * rng.randint(1, 3)
        t = np.array([ord(c) - 96 for c in s] + [0], np.int16)
        assert list(suffix_array(t, 1000)) == sorted(range(len(t)), key=lambda i: list(t[i:]))


def test_repeated_starts_equals_counting():
    rng = random.Random(1)
    for _ in range(100):
        length = rng.choice([8, 11, 16])
        base = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(3)]
        xs = ["".join(rng.choice(base) for _ in range(rng.randint(0, 3))).encode() for _ in range(4)]
        seen = Counter(x[i : i + length] for x in xs for i in range(len(x) - length + 1))
        for x, got in zip(xs, repeated_starts(xs, length), strict=True):
            assert list(got) == [i for i in range(len(x) - length + 1) if seen[x[i : i + length]] > 1]


@pytest.fixture()
def rows(words):
    text = lambda n, seed: " ".join(words(n, seed))
    passage, line = text(70, 1), text(25, 2)
    a = text(300, 3)
    out = [(1, a), (2, a), (2, a), (3, passage + " " + text(100, 4)), (4, text(40, 5) + passage + text(40, 6)), (5, None), (6, ""), (None, a[:900])]
    out += [(7, "é" * 1000), (8, "Is onhe. " * 200), (9, text(60, 7) + text(60, 8) + text(60, 7)), (10, "x" * 399), (11, "y" * 400), (12, "y" * 400)]
    out += [(100 + i, text(30, 50 + i) + line + passage + text(20, 90 + i)) for i in range(12)]
    return out


@pytest.mark.parametrize("hot", [512, 1])
def test_equals_brute_force(make, rows, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = suffix_dedup.remove_repeats(make(rows)).drop("kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, suffix_dedup.LENGTH)


def test_only_different_regions_are_sorted(make, words, monkeypatch):
    """Near copies: what the edit doesn't touch repeats by digest, and only regions around the edit go to a sort."""
    body = words(3000, 11)
    near = [(i, " ".join([*body[: 1500 + i], f"edit{i}", *body[1500 + i :]])) for i in range(6)]
    given = []
    sort = suffix_dedup._sorted_marks
    monkeypatch.setattr(suffix_dedup, "_sorted_marks", lambda regions, length: (given.append(regions.count()), sort(regions, length))[1])
    got = suffix_dedup.remove_repeats(make(near)).drop("kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute(near, suffix_dedup.LENGTH)
    anchors = sum(len(suffix_dedup.anchors(t.encode())[0]) for _, t in near)
    assert given[0] < anchors / 4


def test_one_text_that_repeats_a_phrase(make, words):
    """The places are many, the regions few."""
    rows = [(1, " ".join(words(120, 12)) * 40), (2, " ".join(words(90, 13)))]
    got = suffix_dedup.remove_repeats(make(rows)).drop("kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, suffix_dedup.LENGTH)


def test_empty_table(make):
    assert suffix_dedup.remove_repeats(make([])).collect() == []


def test_anchor_parts_cover_all_windows(words):
    raw = " ".join(words(400_000, 9)).encode()
    assert len(raw) > suffix_dedup._PART
    _, place, first, last = suffix_dedup.anchors(raw)
    covered = np.zeros(len(raw) - suffix_dedup.LENGTH + 1, np.int64)
    for a, b, p in zip(first, last, place, strict=True):
        covered[a : b + 1] += 1
        assert a <= p and p + suffix_dedup.PIECE <= b + suffix_dedup.LENGTH + p - a
    assert covered.min() >= 1

import re
from collections import defaultdict

import pytest

from dimloom.llm.paragraphs import GAP, RUN, repeated_passages, stretches


SF_SMALL = "/root/testdata/sf0.01"


def spans(rows):
    got = defaultdict(set)
    for r in rows:
        got[r.doc_id, r.copy, r.removed].update(range(r.first_word, r.first_word + r.n_words))
    return got


def split(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def repeats(texts, size):
    """Places of words that stand in a run of `size` words that a different text holds too: {text: places}, by brute force."""
    at = defaultdict(set)
    split_texts = {t: split(t) for t in texts}
    for t, w in split_texts.items():
        for i in range(len(w) - size + 1):
            at[hash(tuple(w[i : i + size]))].add(t)
    out = {}
    for t, w in split_texts.items():
        covered = set()
        for i in range(len(w) - size + 1):
            if len(at[hash(tuple(w[i : i + size]))]) > 1:
                covered.update(range(i, i + size))
        if covered:
            out[t] = covered
    return out


def test_passages_inside_lines_and_over_line_breaks(make, words):
    passage = words(60, 1)
    wrapped = "\n".join(" ".join(passage[i : i + 12]) for i in range(0, 60, 12))
    short = words(RUN + GAP - 1, 2)
    docs = [
        (1, " ".join(words(80, 3) + passage + words(70, 4))),
        (2, " ".join(words(55, 5)) + "\n" + wrapped + "\n" + " ".join(words(90, 6))),
        (3, " ".join(words(150, 7) + short)),
        (4, " ".join(short + words(99, 8)).upper()),
        (5, " ".join(words(400, 9))),
        (6, None),
        (7, ""),
        (8, "a b c"),
    ]
    got = spans(repeated_passages(make(docs)).collect())
    assert set(got) == {(1, 0, False), (2, 0, True), (3, 0, False), (4, 0, True)}
    assert got[1, 0, False] <= set(range(80, 140)) and {x - 80 for x in got[1, 0, False]} == {x - 55 for x in got[2, 0, True]}
    assert len(got[2, 0, True]) >= 45 and len(got[4, 0, True]) >= RUN and got[4, 0, True] <= set(range(len(short)))
    assert repeated_passages(make([])).collect() == []


def test_near_copies_of_long_passages(make, words):
    """One word of 70 differs, in the middle of lines of other lengths."""
    base = words(200, 1)
    near = [("changed" if i % 70 == 35 else w) for i, w in enumerate(base)]
    docs = [(1, " ".join(words(40, 2) + base)), (2, " ".join(words(33, 3) + near[:90]) + "\n" + " ".join(near[90:]) + "\n" + " ".join(words(50, 4)))]
    got = spans(repeated_passages(make(docs)).collect())
    assert set(got) == {(1, 0, False), (2, 0, True)}
    assert len(got[2, 0, True]) >= 150 and got[2, 0, True] <= set(range(33, 233))


def test_equal_rows_null_ids_and_texts_that_repeat_themselves(make, words):
    text, other = " ".join(words(100, 1)), " ".join(words(100, 2))
    whole = set(range(100))
    got = spans(repeated_passages(make([(5, text), (5, text), (5, text), (None, other), (None, other + " end"), (9, "la " * 500)])).collect())
    assert got[5, 0, False] == got[5, 1, True] == got[5, 2, True] == whole
    assert not got[5, 0, True] and got[9, 0, True] == set()
    kept, gone = got[None, 0, False], got[None, 0, True]
    # one of the two texts keeps the words, the other loses them; the two lines are near copies as wholes, so "end" belongs to one
    assert kept and whole <= kept | gone <= whole | {100} and len(kept & gone) >= 95
    # a passage that a text repeats far apart goes once; within a text short runs may miss up to GAP - 1 words at each end
    got = spans(repeated_passages(make([(1, text + " " + other + " " + text)])).collect())
    assert got[1, 0, False] <= whole and len(got[1, 0, True]) >= 100 - 2 * (GAP - 1) and got[1, 0, True] <= set(range(200, 300))


def test_words_of_a_copy_that_stays_are_protected():
    row = lambda place, n, c, own, kept: {"place": place, "n": n, "component": c, "first": 1, "own": own, "kept": kept}
    one, more = stretches([row(0, 30, 1, False, 0), row(20, 30, 2, True, 20), row(25, 30, 2, True, 20), row(100, 30, 2, True, 20)])
    assert one == [(20, 35, 1, False), (0, 20, 1, True), (100, 30, 1, True)] and more == [(0, 55, 1, True), (100, 30, 1, True)]


@pytest.mark.parametrize("size, least", [(50, 0.9)])
def test_recall_of_repeated_words(spark, size, least):
    """Words in runs of 50 that stand in several different texts, by brute force over all documents: found in all texts, and removed but for one copy."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    of = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        of.setdefault(r.text, r.doc_id)
    want = {of[t]: places for t, places in repeats(of, size).items()}
    found = spans(repeated_passages(docs.repartition(4)).collect())
    hit = sum(len(places & (found[d, 0, True] | found[d, 0, False])) for d, places in want.items())
    total = sum(map(len, want.values()))
    assert total and hit >= least * total

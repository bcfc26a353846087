import re

import pytest
from helpers import brute_groups, groups
from pyspark.sql import functions as F

from dimloom.llm import decontaminate, jaccard_join, paragraphs
from dimloom.llm.linking import components, link_groups


def edited(words, every, seed):
    return [f"new{seed}x{i}" if i % every == seed % every else w for i, w in enumerate(words)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 299: 299, 300: 299}


def test_link_groups_compares_enough(spark):
    """One large group: two families that link within, single ones, and one link that only two members have."""
    members = spark.createDataFrame([(0, i) for i in range(60)] + [(1, i) for i in (3, 70)], "key long, node long")
    link = lambda a, b: (a < 20 and b < 20 and b - a <= 3) or (20 <= a < 40 and b < 40) or (a == 19 and b == 39)
    asked = []

    def verify(pairs):
        rows = [tuple(r) for r in pairs.collect()]
        asked.extend(rows)
        return spark.createDataFrame([p for p in rows if link(*p)], "a long, b long")

    comp, _ = link_groups(members, verify)
    want = groups([*range(60), 70], [(a, b) for a in range(60) for b in range(a + 1, 60) if link(a, b)])
    assert {r.node: r.component for r in comp.collect()} == want
    assert len(asked) == len(set(asked)) and all(a < b for a, b in asked)


@pytest.fixture()
def rows(words):
    base = words(200, 1)
    out = [(10 + s, " ".join(edited(base, 60, s))) for s in range(25)]  # a family of near copies
    out += [(50, " ".join(base)), (51, " ".join(base).upper()), (51, " ".join(base)), (60, None), (61, ""), (62, " \t\n"), (63, "one two"), (64, "ONE  two"), (65, "one two three")]
    line = words(12, 5)
    out += [(100 + i, " ".join(words(30 + i, 20 + i) + line)) for i in range(15)]  # a line that many share
    return out


def test_join_equals_brute_force(make, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(make(rows)).collect()}
    assert got == brute_groups(rows, 4, 85)
    assert jaccard_join.similar_groups(make(rows)).count() == len(rows)


def test_join_ranks_change_nothing(make, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "RANKED_LAST", 0)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_groups(make(rows)).collect()}
    assert got == brute_groups(rows, 4, 85)


def test_join_null_ids_and_empty_table(make):
    got = jaccard_join.similar_groups(make([(None, "a b c d e"), (3, "a b c d e"), (None, "x y z w v")])).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == [(3, 3), (None, 3), (None, None)]
    assert jaccard_join.similar_groups(make([])).collect() == []


def test_paragraphs_equal_brute_force(make, words):
    base = words(60, 2)
    other = words(45, 3)
    docs = [
        (1, "\n".join([" ".join(words(50, 11)), " ".join(base), "short line"])),
        (2, "short line\n" + " ".join(edited(base, 59, 1)) + "\n" + " ".join(other)),
        (3, " ".join(w.upper() + "," for w in base)),
        (3, "short line"),
        (4, " ".join(edited(base, 3, 2))),
        (5, " ".join(other) + "\n" + " ".join(other)),
        (6, None),
        (7, ""),
        (None, " ".join(other)),
    ]
    lines = []
    for i, t in docs:
        for n, line in enumerate((t or "").split("\n")):
            w = re.findall(r"[0-9a-z]+", line.lower())
            if len(w) >= paragraphs.MIN_WORDS:
                lines.append(((i, n), {tuple(w[j : j + 5]) for j in range(len(w) - 4)}))
    near = [(a, b) for a in range(len(lines)) for b in range(a + 1, len(lines)) if 100 * len(lines[a][1] & lines[b][1]) >= 80 * len(lines[a][1] | lines[b][1])]
    own = groups(range(len(lines)), near)
    want = {}
    for n, c in own.items():
        if sum(v == c for v in own.values()) > 1:
            first = min(lines[m][0] for m, v in own.items() if v == c and lines[m][0][0] is not None)
            want[lines[n][0]] = (*first, lines[n][0] != first)
    got = {(r.doc_id, r.paragraph): (r.first_doc_id, r.first_paragraph, r.removed) for r in paragraphs.repeated_paragraphs(make(docs)).collect()}
    assert got == want and len(want) == 7
    assert paragraphs.repeated_paragraphs(make([])).collect() == []


def test_paragraph_bands_recall(words):
    hits = 0
    for seed in range(60):
        base = words(100, seed)
        near = edited(base, 50, seed)
        a, b = (list(paragraphs.paragraph_shingles(" ".join(w)))[0][3] for w in (base, near))
        hits += bool((paragraphs.band_keys([a]) == paragraphs.band_keys([b])).any())
    assert hits == 60


def test_decontamination_equals_brute_force(spark, make, words):
    items = [(0, " ".join(words(20, 1))), (1, " ".join(words(90, 2))), (2, "too short"), (3, None), (4, " ".join(words(7, 3)))]
    docs = [(i, " ".join(words(400, 30 + i))) for i in range(6)]
    docs += [
        (10, " ".join(words(3000, 40)) + " " + items[0][1].upper() + " " + " ".join(words(2500, 41))),
        (11, " ".join(words(500, 42) + edited(words(90, 2), 89, 5) + words(10, 43))),
        (11, "again " + items[4][1]),
        (12, " ".join(edited(words(90, 2), 10, 1))),
        (13, items[4][1] + "."),
        (14, None),
        (15, "too short"),
        (None, items[1][1]),
    ]
    gram = lambda t: {tuple(w[i : i + 5]) for w in [re.findall(r"[0-9a-z]+", (t or "").lower())] for i in range(len(w) - 4)}
    want = {}
    for d, t in docs:
        for i, u in items:
            q, s = gram(u), gram(t)
            if q and len(q & s) >= 0.8 * len(q):
                want[d, i] = (len(q), max(len(q & s), want.get((d, i), (0, 0))[1]))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for most in (decontaminate.BROADCAST_KEYS, 0):
        old, decontaminate.BROADCAST_KEYS = decontaminate.BROADCAST_KEYS, most
        try:
            got = {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in decontaminate.found_items(make(docs), bench).collect()}
        finally:
            decontaminate.BROADCAST_KEYS = old
        assert got == want and len(want) == 5
    assert decontaminate.found_items(make([]), bench).collect() == []
    assert decontaminate.found_items(make(docs), bench.filter(F.lit(False))).collect() == []


def test_paragraphs_of_rows_without_an_id_stay_once_at_least(make, words):
    text = " ".join(words(40, 7))
    got = {(r.doc_id, r.paragraph): r.removed for r in paragraphs.repeated_paragraphs(make([(None, text), (None, "x\n" + text)])).collect()}
    assert got == {(None, 0): False, (None, 1): True}
    got = {(r.doc_id, r.paragraph): r.removed for r in paragraphs.repeated_paragraphs(make([(None, text), (3, "x\n" + text)])).collect()}
    assert got == {(None, 0): True, (3, 1): False}

"""Decontamination finds items of a few shingles at any place, and items whose shingles are scattered over a document."""

import re

import numpy as np
import pytest

from dimloom.llm import decontaminate


def test_windows_see_short_items(words):
    missed = 0
    for n in (5, 6, 7, 8, 9, 12):
        for seed in range(100):
            item = words(n, 1000 + seed)
            text = words(40 + seed, seed) + item + words(60, 500 + seed)
            c = decontaminate.size_class(n - 4)
            keys = np.concatenate([k for k, _ in decontaminate.window_keys([decontaminate.shingles(" ".join(text))], [c])])
            missed += not np.isin(decontaminate.item_keys(" ".join(item)), keys).any()
    assert missed == 0


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_KEYS, 0])
def test_short_and_scattered_items(spark, make, words, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", most)
    items = [(n * 100 + s, " ".join(words(n, 2000 + 50 * n + s))) for n in (5, 6, 7, 8) for s in range(10)]
    long = words(60, 77)
    items += [(1, " ".join(long)), (1, "another text of the same id"), (None, " ".join(words(9, 78)))]
    docs = [(i, " ".join(words(30 + 7 * i, i) + items[i][1].split() + words(50, 300 + i))) for i in range(40)]
    far = [x for at in range(0, 60, 20) for x in [*long[at : at + 24], *words(700, 400 + at)]]
    docs += [(90, " ".join(far)), (None, items[5][1] + " x " + items[-1][1]), (91, "now another text of the same id"), (92, None), (93, " ".join(long[:40]))]
    gram = lambda t: {tuple(w[i : i + 5]) for w in [re.findall(r"[0-9a-z]+", (t or "").lower())] for i in range(len(w) - 4)}
    want = {(d, i) for d, t in docs for i, u in items if len(gram(u) & gram(t)) >= 0.8 * len(gram(u))}
    assert {(90, 1), (91, 1), (None, None)} < want and len(want) >= 44
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in decontaminate.found_items(make(docs), bench).collect()]
    assert len(got) == len(set(got)) and set(got) == want

"""Toxicity: held-out recall by language, and lookups of words by their whole hashes."""

import zlib

import numpy as np
import pytest

from dimloom.llm import toxicity
from dimloom.llm.common import table


@pytest.mark.parametrize(("sf", "least"), [("sf0.01", {"en": 0.75}), ("sf0.1", {"en": 0.8, "de": 0.8, "fr": 0.8, "es": 0.3})])
def test_recall_by_language(spark, sf, least):
    docs, labels = (table(spark, f"/root/testdata/{sf}", name) for name in ("documents", "labels"))
    got = toxicity.scored(docs.join(labels, "doc_id"), toxicity.learn(docs, labels), ["doc_id", "toxic", "lang"]).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    for lang, share in least.items():
        toxic = [r.score >= 0.5 for r in held if r.toxic and r.lang == lang]
        assert sum(toxic) >= share * len(toxic), lang
    called = [r.toxic for r in held if r.score >= 0.5]
    assert sum(called) >= 0.75 * len(called)


def test_words_are_compared_whole(spark, make, words, monkeypatch):
    docs, labels = (table(spark, "/root/testdata/sf0.01", name) for name in ("documents", "labels"))
    rows = [(i, r.text) for i, r in enumerate(docs.orderBy("doc_id").limit(40).collect())]
    rows += [(1, rows[1][1]), (90, rows[1][1]), (91, None), (92, ""), (None, "scum trash")]
    given = make(rows)
    model = toxicity.learn(docs, labels)
    whole = sorted(((r.doc_id, r.score) for r in toxicity.scored(given, model, ["doc_id"]).collect()), key=str)
    # an unseen word with the low bits of a strong one has no evidence of its own
    low = np.uint64((1 << 21) - 1)
    strong = set((model.hot[model.ratio[0] > 2] & low).tolist())
    known = set(model.hot.tolist())
    letters = "abcdefghijklmnopqrstuvwxyz"
    stranger = None
    for n in range(400):
        made = [f"{letters[n % 26]}q{a}{b}{c}{letters[n // 26]}x" for a in letters for b in letters for c in letters[:8]]
        h, of = toxicity.words_of(made)
        at = [i for i, x in enumerate(h.tolist()) if x & int(low) in strong and x not in known]
        if at:
            stranger = made[of[at[0]]]
            break
    assert stranger
    x = toxicity.inputs(make([(1, stranger)]), model, ["doc_id"]).first().x0
    assert x[0] == pytest.approx(model.common[0])
    # with few words sent to every task, the others are joined
    monkeypatch.setattr(toxicity, "BROADCAST_WORDS", 20)
    model = toxicity.learn(docs, labels)
    assert len(model.hot) <= 20 and model.rest.count() > 100
    joined = sorted(((r.doc_id, r.score) for r in toxicity.scored(given, model, ["doc_id"]).collect()), key=str)
    assert [i for i, _ in joined] == [i for i, _ in whole]
    assert np.allclose([s for _, s in joined], [s for _, s in whole], atol=1e-4)

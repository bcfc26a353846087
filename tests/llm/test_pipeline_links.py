"""The pipeline's near-duplicate stage links by five-word shingles at a similarity of 0.8."""

from helpers import brute_groups

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_jaccard_stage_finds_pairs_over_080(spark, make, words):
    base = words(200, 1)
    near = [w if i % 50 != 25 else f"new{i}" for i, w in enumerate(base)]  # 4 of 200 words
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(words(200, 2)))]
    at = lambda k, percent: {i: c for i, (_, c) in brute_groups(rows, k, percent).items()}
    assert at(5, 80) == {1: 1, 2: 1, 3: 3} and at(4, 85) == {1: 1, 2: 2, 3: 3}
    rows.append((4, " ".join(w if i % 40 != 20 else f"new{i}" for i, w in enumerate(words(200, 2)))))  # 5 of 200 words: 0.77
    assert at(5, 80)[4] == 4
    kept = corpus_pipeline.jaccard_join(spark, make(rows), SF)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]

"""Each stage of the pipeline against brute force on its own input (sf0.001 with planted rows)."""

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import brute_groups, check_packed

import corpus_pipeline
from dimloom.llm import packing

SF = "/root/testdata/sf0.001"


def rows(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]


@pytest.fixture(scope="module")
def staged(spark):
    """The tables that go in and come out of each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    text = docs.filter("n_chars > 2000").orderBy("doc_id").first().text
    more = [(9001, None), (9002, ""), (9003, "12 34"), (9004, "Some words and then " + item), (9005, text), (9006, text), (9006, text), (None, text[:1500] + " more")]
    more = [(i, t, "en", "s", len(t or "")) for i, t in more]
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.saved(stage(spark, out[-1], SF), name))
    return out


def test_stages_keep_the_columns(staged):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "suffix_dedup", "decontamination", "best_fit_packing"]
    for df in staged[1:5]:
        assert df.dtypes == staged[0].dtypes


def test_language_id(staged):
    gone = Counter(rows(staged[0])) - Counter(rows(staged[1]))
    assert {r[0] for r in gone} == {9001, 9002, 9003}


def test_jaccard_join(staged):
    given = rows(staged[1])
    groups = brute_groups([(r[0], r[1]) for r in given if r[0] is not None], 5, 80)
    want = {r for r in given if r[0] is None or groups[r[0]][1] == r[0]}
    assert Counter(rows(staged[2])) == Counter(want)


def test_suffix_dedup(staged):
    given, length = rows(staged[2]), 400
    raw = [r[1].encode() for r in given]
    seen = Counter(b[j : j + length] for b in raw for j in range(len(b) - length + 1))
    want = Counter()
    for r, b in zip(given, raw, strict=True):
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone[j : j + length] = True
        text = np.frombuffer(b, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
        if text:
            want[r[0], text, r[2], r[3], len(text)] += 1
    assert Counter(rows(staged[3])) == want


def test_decontamination(spark, staged):
    gram = lambda t: {tuple(w[i : i + 5]) for w in [re.findall(r"[0-9a-z\u0080-\U0010ffff]+", t.lower())] for i in range(len(w) - 4)}
    items = [g for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if (g := gram(r.text))]
    given = rows(staged[3])
    want = [r for r in given if all(len(g & gram(r[1])) < 0.8 * len(g) for g in items)]
    assert Counter(rows(staged[4])) == Counter(want)
    assert 9004 not in {r[0] for r in want} and len(want) < len(given)


def test_packing(staged):
    got = staged[5].collect()
    check_packed(got, 4096)
    ids = packing.ChunkIds(public_tokenizers.path("word_bpe_49k.json"))
    assert sum(r.length for r in got) == sum(len(ids.text(r[1])) // 4 + 1 for r in rows(staged[4]))


def test_run_is_the_stages(spark, staged):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == staged[5].columns and got.count() > 0


def test_clashing_columns_and_no_n_chars(spark):
    """Columns of names that the stages use themselves go through all of them unchanged, and nothing else changes."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60")
    names = ["score", "rejected", "lang_pred", "_row", "key", "_rest", "_text", "id", "node", "a.b"]
    wide = docs.drop("n_chars").select("*", *[(corpus_pipeline.F.col("doc_id") * 10 + i).alias(c) for i, c in enumerate(names)])
    plain = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        wide, plain = (corpus_pipeline.saved(stage(spark, d, SF), name) for d in (wide, plain))
        assert wide.columns == ["doc_id", "text", "lang", "source", *names]
    got = wide.collect()
    assert {(r.doc_id, r.text) for r in got} == {(r.doc_id, r.text) for r in plain.collect()} and len(got) > 10
    assert all([r[c] for c in names] == [r.doc_id * 10 + i for i in range(len(names))] for r in got)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.saved(stage(spark, docs, SF), name)
        assert docs.count() == 0

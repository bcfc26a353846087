import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from helpers import check_packed

from dimloom.llm import fingerprint, language_id, packing, token_count, toxicity, url_rules
from dimloom.llm.common import table

SF = "/root/testdata/sf0.01"
LETTERS = "aAb  \n\t'sÉÜ漢字😀.,th ion\x00́ing0123 \x1c\u0085Σς▁İ"


def noise(rng, most=30):
    return "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, most)))


def texts(spark, n=60):
    return [r.text for r in table(spark, SF, "documents").orderBy("doc_id").limit(n).collect()]


def test_token_counts_equal_the_library(spark, make):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(4)
    rows = [noise(rng) for _ in range(1500)] + texts(spark) + ["a" * 30000, " " * 5000, "<s> </s> <unk>", "", None]
    got = token_count.token_counts(make(list(enumerate(rows))), path, limit=100).collect()
    for r in got:
        t = rows[r.doc_id] or ""
        n = len(model.encode(t))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 100), t
    assert token_count.token_counts(make([]), path).collect() == []


def test_chunk_ids_equal_the_library(spark):
    ids = packing.ChunkIds(public_tokenizers.path("word_bpe_49k.json"), most=50)
    rng = random.Random(5)
    for t in [noise(rng) for _ in range(1500)] + texts(spark) + ["x<|endoftext|> <|startoftext|>y", "don't", "É.Ü!"]:
        assert np.frombuffer(ids.text(t), "<u4").tolist() == ids.tokenizer.encode(t, add_special_tokens=False).ids


def fewest(lengths, cap):
    """Fewest sequences, by all subsets."""
    best = [(0, cap)] + [(99, 0)] * ((1 << len(lengths)) - 1)
    for m in range(len(best)):
        n, used = best[m]
        for i, w in enumerate(lengths):
            if not m >> i & 1:
                best[m | 1 << i] = min(best[m | 1 << i], (n, used + w) if n and used + w <= cap else (n + 1, w))
    return best[-1][0]


def test_reduction_keeps_the_optimum():
    rng = random.Random(6)
    for _ in range(150):
        cap = rng.choice([10, 20, 50])
        lengths = [rng.randint(1, cap) for _ in range(rng.randint(1, 8))]
        counts = np.bincount(lengths, minlength=cap + 1)
        plan = packing.Plan(counts, cap)
        packing.reduce_instance(plan)
        rest = [w for w in range(cap + 1) for _ in range(int(plan.left[w]))]
        assert plan.bins + (fewest(rest, cap) if rest else 0) == fewest(lengths, cap)


def test_packing_equals_the_contract(spark, make):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(i, t) for i, t in enumerate(texts(spark))] + [(100, None), (101, ""), (102, "word " * 9000), (103, "same"), (103, "same"), (None, "x y")]
    got = packing.pack_documents(make(rows), path).collect()
    tokenizer = packing.ChunkIds(path).tokenizer
    want = Counter()
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[i, n, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    used = check_packed(got, 4096)
    assert used <= 1.05 * -(-sum(r.length for r in got) // 4096) + 1
    assert packing.pack_documents(make([]), path).collect() == []


def test_packing_many_of_one_length(spark):
    rows = [(i, 0, 0, 1000 if i % 3 else 96, 7) for i in range(3000)] + [(i, 0, 0, 3 + i % 50, 7) for i in range(3000, 3500)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = packing.pack(df).collect()
    assert len(got) == len(rows) and len({(r.sequence_id, r.offset) for r in got}) == len(rows)
    assert check_packed(got, 4096) <= -(-sum(r[3] for r in rows) // 4096) + 1


def test_fingerprints_equal_the_contract(spark, make):
    rows = [(i * 7 % 101, t) for i, t in enumerate(texts(spark, 80))] + [(200, None), (201, ""), (202, "é"), (203, "same text"), (203, "same text"), (None, "none")]
    got = fingerprint.fingerprints(make(rows)).collect()
    assert len(got) == len(rows)
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    want = Counter()
    for n, (i, t) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        e = fingerprint.edited(t, following)
        a, b, c = map(fingerprint.chunk_set, (t, e, following))
        want[i, len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprint.as_text(a), fingerprint.as_text(b), fingerprint.likeness(a, b), fingerprint.likeness(a, c)] += 1
    assert Counter(map(tuple, got)) == want
    assert fingerprint.fingerprints(make([])).collect() == []


def test_fingerprints_resist_shifts(spark):
    for t in (t for t in texts(spark) if len(t) > 3000):
        moved = "An inserted sentence. " + t[:1500] + " and one more" + t[1500:]
        a, b = fingerprint.chunk_set(t), fingerprint.chunk_set(moved)
        assert fingerprint.likeness(a, b) > 0.8
        raw = t.encode()
        ends = fingerprint.boundaries(raw)
        assert ends == fingerprint.boundaries(raw) and ends[-1] == len(raw)
        sizes = np.diff([0, *ends])
        assert sizes.max() <= fingerprint.MAX and sizes[:-1].min() >= fingerprint.MIN


def test_gear_hash_equals_its_definition():
    data = np.random.default_rng(1).integers(0, 256, 300).astype(np.uint8)
    want = [sum(int(fingerprint.GEAR[data[i - j]]) << j for j in range(min(32, i + 1))) % (1 << 32) for i in range(300)]
    assert fingerprint.gear_hashes(data).tolist() == want


def test_language_held_out(spark):
    docs = table(spark, SF, "documents")
    got = language_id.predict(docs, language_id.learn(docs), keep=("lang",)).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(got) == docs.count() and len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and sum(r.rejected for r in got) < 0.01 * len(got)


def test_language_edge_cases(spark, make):
    docs = table(spark, SF, "documents")
    model = language_id.learn(docs)
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, docs.filter("lang = 'de'").first().text), (4, None), (None, "été des les"), (5, "the and " * 300_000)]
    got = sorted(((r.doc_id, r.lang_pred, r.score == 0, r.rejected) for r in language_id.predict(make(rows), model).collect()), key=str)
    assert got == sorted([(1, "und", True, True), (2, "und", True, True), (3, "und", True, True), (4, "de", False, False), (4, "und", True, True), (None, "fr", False, False), (5, "en", False, False)], key=str)
    none = language_id.learn(make([(1, "text", None), (2, None, None)]))
    assert [(r.lang_pred, r.score) for r in language_id.predict(make([(1, "text")]), none).collect()] == [("und", 0.0)]
    assert language_id.predict(make([]), model).collect() == []


def test_toxicity_held_out(spark, make):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.learn(docs, labels)
    got = toxicity.scored(docs.join(labels, "doc_id"), model, ["doc_id", "toxic"]).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    called = [r for r in held if r.score >= 0.5]
    assert len(called) >= 0.4 * sum(r.toxic for r in held)
    assert sum(r.toxic for r in called) >= 0.95 * len(called)
    rows = [(1, None), (2, ""), (3, "!!"), (4, "moron " + "stupid idiot scum " * 2), (None, "the and of"), (5, "the and of " * 200_000)]
    edge = {r.doc_id: r.score for r in toxicity.scored(make(rows), model, ["doc_id"]).collect()}
    assert edge[1] == edge[2] == edge[3] < 0.5 < edge[4] and edge[5] < 0.5
    assert toxicity.scored(make([]), model, ["doc_id"]).collect() == []


def test_toxicity_without_labels(spark, make):
    docs = make([(1, "a b"), (2, "c d")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(docs, none)
    assert [r.score for r in toxicity.scored(docs, model, ["doc_id"]).collect()] == [0.0, 0.0]


URLS = [None, "", "nothing", "http://", "HTTP://EXAMPLE.org", "http://a.Example.ORG/en/12?x#y", "http://example.org/es/", "x://org/", "x://borg/", "x://a.com?/fr/", "x://a.com#/fr/", "x://a.b.com/fr/1", "x://com/de/", "x://exÀmple.org/é", "x://example.org://en/1", "x://.org/", "x://org./", "x://a.org/en/1"]


@pytest.mark.parametrize("times", [1, 400])
def test_url_rules_equal_sql(spark, times):
    rows = [(i * 1000 + n, u) for n in range(times if times == 1 else 2) for i, u in enumerate(URLS)] + [(10**6 + n, "x://a.b.com/fr/1") for n in range(times)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = spark.createDataFrame(url_rules.RULES, "host string, path string, verdict string")
    got = sorted(map(tuple, url_rules.judge(pages, rules).collect()), key=str)
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    assert got == sorted(con.sql(url_rules.OP8_SQL).fetchall(), key=str)


def test_url_rules_general(spark):
    rng = random.Random(8)
    label = lambda: rng.choice(["a", "b", "ab", "c-d", "org"])
    host = lambda n: ".".join(label() for _ in range(rng.randint(1, n)))
    path = lambda: "".join("/" + rng.choice(["a", "ab", "", "b"]) for _ in range(rng.randint(0, 3)))
    rules = list({(host(3), path()): rng.choice(["allow", "block"]) for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [(i, f"s://{host(4)}{path()}?q") for i in range(800)]

    def want(u):
        h, slash, p = u[4:-2].partition("/")
        p = slash + p
        fit = [(len(rh + rp), len(rh), v == "block", rh + rp, v) for rh, rp, v in rules if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
        return (max(fit)[3:]) if fit else (None, "block")

    df = spark.createDataFrame(urls, "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string"), default="block").collect()}
    assert got == {i: want(u) for i, u in urls}
    nothing = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_rules.judge(df, nothing).collect()} == {"allow"}
    assert url_rules.judge(df.limit(0), nothing).collect() == []


def test_url_rules_use_no_python(spark):
    plan = url_rules.op8_url_rules(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

"""The manifest against a plain Python one: trees, proofs and folded roots of every row."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from dimloom.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, leaf int, at int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, i):
    for nodes in tree[:-1]:
        a = i // 16 * 16
        yield "".join(nodes[a:i]), "".join(nodes[i + 1 : a + 16])
        i //= 16


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees.append(levels([leaf(r, r["text"]) for r in groups[s]]))
    top, out = levels([t[-1][0] for t in trees]), []
    for k, (s, tree) in enumerate(zip(sources, trees, strict=True)):
        for i, r in enumerate(groups[s]):
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            beside, folded = [*path(tree, i), *path(top, k)], leaf(r, text)
            for left, right in beside:
                folded = h(left + folded + right)
            root = top[-1][0]
            proof = h("".join(a + b for a, b in beside))
            out.append((r["doc_id"], leaf(r, r["text"]), tree[-1][0], root, proof, folded, folded == root))
    return out


def compare(docs):
    got = merkle.tampered_manifest(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    key = lambda t: tuple((x is not None, str(x)) for x in t)
    rows = sorted((tuple(r) for r in got.collect()), key=key)
    assert rows == sorted(brute([r.asDict() for r in docs.collect()]), key=key)
    return rows


def table(spark, rows):
    """(doc_id, text, source) rows, with extra columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, t, "en" if i is None or i % 7 else None, s, len(t or ""), "x", 1, 2) for i, t, s in rows], SCHEMA)


@pytest.mark.parametrize("copies", [4096, 2])
def test_many_levels_sources_nulls_ties_and_copied_nodes(spark, monkeypatch, copies):
    monkeypatch.setattr(merkle, "RUNS_A_COPY", copies)
    rows = [(i, None if i % 11 == 0 else "É Text " * (i % 3) + "Zz", "hot") for i in range(300)]
    rows += [(i, "A", None if i % 2 else f"s{i}") for i in range(300, 340)]
    rows += [(5, "Same", "hot")] * 3 + [(None, "Null", "hot")] * 2 + [(None, None, None), (400, "", "é"), (401, "Q" * 200_000, "Z")]
    got = compare(table(spark, rows))
    assert 0 < sum(not r[-1] for r in got) < len(got)


@pytest.mark.parametrize("rows", [[], [(5, "A", None)], [(i, "Ab", "one") for i in range(16)], [(i, "Ab", "one") for i in range(17)], [(i, "Ab", f"s{i}") for i in range(17)]])
def test_small_shapes(spark, rows):
    compare(table(spark, rows))


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    assert len(compare(docs)) == docs.count()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit", None) == before


def test_a_recursive_query_climbs(spark):
    docs = table(spark, [(i, "Ab", "one") for i in range(300)])
    start = merkle._CLIMB
    assert "WITH RECURSIVE" in start and "UNION ALL" in start
    many = merkle.manifest(docs, F.lit(True), {"text": F.lit("other")})
    assert not many.filter("verified").count() and many.select("root").distinct().count() == 1

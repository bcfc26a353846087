"""Links and components of vectors against all pairs in double precision."""

import collections

import numpy as np
import pytest

from dimloom.llm import embedding_dedup as dedup

SCHEMA = "vec_id long, embedding array<double>, label int, node string, first int, h int"


def brute(rows, least=0.98):
    groups, own, links = collections.defaultdict(list), list(range(len(rows))), [0] * len(rows)

    def find(x):
        while own[x] != x:
            own[x] = own[own[x]]
            x = own[x]
        return x

    for i, (_, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v):
            groups[label, len(v)].append(i)
    for members in groups.values():
        m = np.array([rows[i][1] for i in members], float)
        m /= np.abs(m).max(axis=1)[:, None]
        m /= np.linalg.norm(m, axis=1)[:, None]
        for r in range(len(members)):
            for s in r + 1 + np.flatnonzero(m[r + 1 :] @ m[r] >= least):
                a, b = members[r], members[s]
                links[a] += 1
                links[b] += 1
                a, b = sorted((find(a), find(b)))
                own[b] = a
    ids = collections.defaultdict(list)
    for i, r in enumerate(rows):
        ids[find(i)].append(r[0])
    least_id = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((r[0], links[i], least_id[find(i)], r[0] == least_id[find(i)]) for i, r in enumerate(rows)), key=str)


def found(df, **kw):
    out = dedup.similar_vectors(df, **kw)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def families(seed=0, d=24):
    """Near copies around centres (chains among them), copies, and noise, under three labels."""
    rng, rows = np.random.default_rng(seed), []
    for c in range(30):
        centre = rng.standard_normal(d)
        for _ in range([1, 2, 5, 40][c % 4]):
            rows.append((centre + rng.standard_normal(d) * 0.11 * rng.random()).tolist())
    rows += [rows[3]] * 60 + rng.standard_normal((150, d)).tolist()
    return [(int(i), v, [1, 1, 1, 2, None][n % 5]) for n, (i, v) in enumerate(zip(rng.permutation(len(rows)), rows, strict=True))]


@pytest.mark.parametrize("entries,tile", [(1 << 22, 2048), (24 * 37, 16)])
def test_equals_all_pairs(spark, monkeypatch, entries, tile):
    monkeypatch.setattr(dedup, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(dedup, "TILE", tile)
    rows = families()
    got = found(spark.createDataFrame([(*r, "x", 7, 8) for r in rows], SCHEMA))
    assert got == brute(rows) and max(r[1] for r in got) > 30


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/check_s/embeddings.parquet").filter("label < 3").limit(2500)
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert found(spark.createDataFrame([(*r, "x", 7, 8) for r in rows], SCHEMA)) == brute(rows)


def test_unusable_rows_extremes_and_ties(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [1e-200, 0.0], 1), (3, [1e300, 1e299], 1), (4, [0.0, 0.0], 1), (5, None, 1), (6, [1.0, None], 1), (7, [1.0, inf], 1),
            (8, [nan, 1.0], 1), (None, [1.0, 0.0], 1), (9, [1.0, 0.0], None), (10, [1.0, 0.0], 2), (10, [1.0, 0.0], 2), (11, [1.0], 1), (12, [-2.0], 1),
            (13, [3.0], 1), (14, [], 1), (15, [-0.0, 1.0], 4), (16, [0.0, 1.0], 4), (17, [1.0, 0.0, 0.0], 1)]
    got = found(spark.createDataFrame([(*r, "x", 7, 8) for r in rows], SCHEMA))
    assert got == brute(rows)
    alone = spark.createDataFrame([(None, [1.0, 0.0], 1, "x", 7, 8)] * 2, SCHEMA)
    assert found(alone) == [(None, 1, None, True)] * 2
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_long_vectors_and_the_bound_of_quantisation():
    rng = np.random.default_rng(3)
    u = dedup.unit(rng.standard_normal((200, 2500)))
    q, s, e = dedup.quantised(u)
    product = (s[:, None] * s) * (q.astype(np.int64) @ q.T.astype(np.int64))
    assert (np.abs(u @ u.T - product) <= e[:, None] + (1 + e[:, None]) * e[None, :]).all()
    near = dedup.unit(u + 0.2 / np.sqrt(2500) * rng.standard_normal(u.shape))
    both = dedup.unit(np.concatenate((u, near)))
    block = dedup._Block(both.tobytes(), np.ones(len(both), np.int64).tobytes(), 2500, 0, 0)
    got = dedup.meet([block], 0.98)
    expect = ((both @ both.T >= 0.98).sum(axis=1) - 1)
    assert got.column("node").to_pylist() == np.flatnonzero(expect).tolist() and got.column("links").to_pylist() == expect[expect > 0].tolist()


def test_blocks_apart_do_not_meet(spark, monkeypatch):
    """Two tight bundles under one label: the angles alone part their blocks."""
    monkeypatch.setattr(dedup, "BLOCK_ENTRIES", 8 * 50)
    met = []
    monkeypatch.setattr(dedup, "saved", lambda df, name, save=dedup.saved: (met.append(save(df, name)) or met[-1]) if name == "meetings" else save(df, name))
    rng = np.random.default_rng(5)
    ends = np.eye(8)[:2].repeat(50, axis=0)
    rows = [(i, v, 1) for i, v in enumerate((ends + 0.01 * rng.standard_normal(ends.shape)).tolist())]
    got = found(spark.createDataFrame([(*r, "x", 7, 8) for r in rows], SCHEMA))
    assert got == brute(rows) and met[0].count() == 0

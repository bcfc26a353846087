"""Whitening against numpy's eigenvectors, and its eigenvalue steps alone."""

import numpy as np
import pytest

from dimloom.llm import whitening as white

RNG = np.random.default_rng(1)
MATRICES = {
    "full": RNG.standard_normal((40, 60)), "few dimensions": RNG.standard_normal((3, 9)), "rank 5": RNG.standard_normal((30, 5)), "equal": np.eye(20),
    "blocks": np.kron(np.eye(4), RNG.standard_normal((5, 5))), "one": np.ones((1, 1)), "scaled": RNG.standard_normal((30, 30)) * np.logspace(0, -6, 30)[:, None],
}


@pytest.mark.parametrize("name", MATRICES)
def test_leading_components(name):
    v = MATRICES[name] @ MATRICES[name].T
    values, vectors = white.principal(v, 16)
    expect = np.linalg.eigvalsh(v)[::-1][:16]
    assert np.abs(values - expect).max() <= 1e-13 * expect[0]
    assert np.abs(v @ vectors - vectors * values).max() <= 1e-13 * expect[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-12


def test_steps():
    v = MATRICES["full"] @ MATRICES["full"].T
    diagonal, beside, _ = white.tridiagonal(v)
    t = np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1)
    real = np.linalg.eigvalsh(v)
    assert np.allclose(np.linalg.eigvalsh(t), real)
    at = np.linspace(real[0] - 1, real[-1] + 1, 50)
    assert white.sturm_count(diagonal, beside, at).tolist() == [(real < x).sum() for x in at]


def brute(rows):
    kept = [(i, np.floor(64 * np.array(v, float)).astype(np.int64) + 1_000_000) for i, v in rows]
    fit = np.unique(np.array([x for _, x in kept]), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = (fit - s // n) - (s % n) / n
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    order = [j for j in np.argsort(values)[::-1][:16] if values[j] > 1e-10 * values.max()]
    out = {}
    for i, x in kept:
        exact = sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s, strict=True))
        out[i] = (n, exact, ((x - s // n) - (s % n) / n) @ vectors[:, order] / np.sqrt(values[order]), values[order] / np.trace(v))
    return out


def check(df, rows, per_row):
    got = white.whitened(df)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got, expect = got.collect(), brute(rows)
    assert len(got) == per_row * len(rows)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert by.keys() == expect.keys()
    mine = np.array([[by[i][c].whitened for c in sorted(by[i])] for i in by])
    theirs = np.array([expect[i][2] for i in by])
    sign = np.sign((mine * theirs).sum(axis=0))
    assert np.abs(mine - theirs * sign).max() < 1e-6
    for i, rs in by.items():
        assert sorted(rs) == list(range(1, per_row + 1))
        n, deviation, _, explained = expect[i]
        assert {(r.n, r.deviation, r.deviation_exact) for r in rs.values()} == {(n, deviation if deviation < 1 << 63 else None, str(deviation))}
        assert np.allclose([rs[c].explained for c in sorted(rs)], explained, rtol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-4


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    check(df.repartition(7), rows, 16)


def test_copies_count_once_and_unusable_rows_go(spark):
    good = RNG.standard_normal((60, 5)).round(3).tolist()
    rows = [(i, v) for i, v in enumerate(good)] + [(100 + i, good[0]) for i in range(40)] + [(200, [float(2**40), 0.0, -5e7, 1.0, 3e4])]
    bad = [(300, None), (301, [1.0, None, 1.0, 1.0, 1.0]), (302, [float("nan")] * 5), (303, [float("inf")] * 5), (304, [1.0]), (305, [])]
    schema = "vec_id long, embedding array<double>, x string, n int, component int"
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows + bad], schema)
    got = white.whitened(df)
    assert {r.vec_id for r in got.select("vec_id").collect()} == {i for i, _ in rows}
    assert {r.n for r in got.select("n").collect()} == {61}
    usable = df.filter("vec_id < 200 or vec_id > 299")
    check(usable, rows[:-1], 5)


def test_repeated_ids_null_ids_and_tables_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 3.0]), (2, [2.0, 2.0])], schema)
    got = white.whitened(df).groupBy("vec_id").count().collect()
    assert {(r[0], r[1]) for r in got} == {(1, 4), (None, 2), (2, 2)}
    for flat in (df.limit(0), df.filter("vec_id = 1"), spark.createDataFrame([(1, None)], schema), spark.createDataFrame([(1, [])], schema)):
        assert white.whitened(flat).collect() == []

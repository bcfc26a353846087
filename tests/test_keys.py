"""K1/K2: dense keys equal a global row_number whatever the bucketing."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from dimloom.operators.dims import new_rows
from dimloom.operators.keys import assign_keys, continue_keys, number_rows, unique_keys


def _brute(df, order, key):
    w = Window.orderBy(*order)
    return {tuple(r[c] for c in order): r[key] for r in df.withColumn(key, F.row_number().over(w)).collect()}


def test_keys_match_global_row_number_across_buckets(spark):
    rows = [(i % 97, None if i % 11 == 0 else f"s{i % 13}", i) for i in range(5000)]
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(7)
    order = ["a", "b", "c"]
    expect = _brute(df, order, "k")
    for bucket_rows in (None, 50, 400, 10_000):
        keyed = assign_keys(df, order, "k", bucket_rows=bucket_rows)
        got = {tuple(r[c] for c in order): r["k"] for r in keyed.df.collect()}
        assert keyed.rows == 5000
        assert got == expect, bucket_rows


def test_keys_stable_across_partitioning(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 3001).alias("x"))
    a = {r.x: r.k for r in assign_keys(df.repartition(3), ["x"], "k", bucket_rows=100).df.collect()}
    b = {r.x: r.k for r in assign_keys(df.repartition(11), ["x"], "k", bucket_rows=100).df.collect()}
    assert a == b and sorted(a.values()) == list(range(1, 3001))


def test_continue_keys_and_unique(spark):
    existing = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "k int, v string")
    new = spark.createDataFrame([("d",), ("c",)], "v string")
    got = continue_keys(new, existing, ["v"], "k").df.orderBy("k").collect()
    assert [(r.k, r.v) for r in got] == [(4, "c"), (5, "d")]
    u = unique_keys(existing, ["v"], "k").orderBy("v").collect()
    assert [(r.v, r.k) for r in u] == [("a", 1), ("b", 2)]


def test_empty_input(spark):
    df = spark.createDataFrame([], "x int")
    keyed = assign_keys(df, ["x"], "k")
    assert keyed.rows == 0 and keyed.df.count() == 0


def test_thousands_of_ranges_and_empty_ones(spark):
    df = spark.range(8_000).select((F.col("id") * 7919 % 8_009).alias("x"), F.lit("é").alias("t"))
    keyed = assign_keys(df, ["x"], "k", bucket_rows=2)
    assert keyed.rows == 8_000 and keyed.text_bytes == 16_000
    plan = keyed.df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "Window" not in plan and "aggregate(" not in plan
    assert keyed.df.inputFiles() and len(keyed.df.inputFiles()) > 3500
    got = keyed.df.select("x", "k").toArrow().sort_by("x").column("k").to_pylist()
    assert got == list(range(1, 8_001))


def test_rows_that_tie_have_one_place_each(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None)], "x int, t string")
    numbered = number_rows(df, ["x", "t"], "place", 3)
    once, again = (sorted(r.place for r in numbered.df.collect()) for _ in range(2))
    assert once == again == [0, 1, 2, 3]
    assert [r.x for r in numbered.df.orderBy("place").collect()] == [None, 1, 1, 2]


def test_null_keys_pass_beside_the_anti_join(spark):
    incoming = spark.createDataFrame([(1, "a", 5), (None, "b", 6), (2, None, 7), (3, "c", 8)], "x int, t string, v int")
    existing = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "x int, t string")
    got = new_rows(incoming, existing, ["x", "t"])
    assert got.columns == ["x", "t", "v"] and sorted(r.v for r in got.collect()) == [6, 7, 8]

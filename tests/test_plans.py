"""Plan shapes that the scale design relies on."""

from pyspark.sql import functions as F

from dimloom.operators.fact import LookupSpec, dedupe, lookup
from dimloom.operators.keys import assign_keys


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_before_shuffle_and_survives_hot_key(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("eventid"),  # a third share one id
        F.col("id").alias("tie"))
    out = dedupe(df, ["eventid"], ["tie"])
    plan = _plan(out)
    assert plan.count("WindowGroupLimit") >= 2          # partial (map side) and final
    rows = out.where("eventid = -1").collect()
    assert len(rows) == 1 and rows[0].tie == 0
    assert out.count() == n - n // 3 + 1


def test_broadcast_follows_measured_size(spark):
    fact = spark.range(1000).select((F.col("id") % 50).alias("code"))
    dim = spark.range(50).select(F.col("id").cast("int").alias("k"), F.col("id").alias("code"))
    spec = LookupSpec("D", "k", (("code", "code"),))
    assert "BroadcastHashJoin" in _plan(lookup(fact, dim, spec, 50, 0))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        small_limit = _plan(lookup(fact, dim, spec, 50, 0))
        assert "BroadcastHashJoin" not in small_limit and "SortMergeJoin" in small_limit
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" not in _plan(lookup(fact, dim, spec, None))  # unknown size: never


def test_keys_window_is_partitioned(spark):
    df = spark.range(20000).select((F.col("id") * 7919 % 20011).alias("x"))
    keyed = assign_keys(df, ["x"], "k", bucket_rows=2000)
    plan = _plan(keyed.df)
    assert "SinglePartition" not in plan
    assert sorted(r.k for r in keyed.df.collect()) == list(range(1, 20001))


def test_new_rows_scans_existing_without_shuffle(spark):
    from dimloom.operators.dims import new_rows

    existing = spark.range(200000).select(F.col("id").alias("k"))
    incoming = spark.createDataFrame([(5,), (300000,), (None,)], "k long")
    fresh = new_rows(incoming, existing, ["k"], 3)
    plan = _plan(fresh)
    assert "SortMergeJoin" not in plan and "LeftSemi" in plan and "LeftAnti" in plan
    assert sorted((r.k is None, r.k) for r in fresh.collect()) == [(False, 300000), (True, None)]
    unbounded = _plan(new_rows(incoming, existing, ["k"]))
    assert "SortMergeJoin" in unbounded


def test_salted_lookup_equals_plain_join(spark):
    from dimloom.operators.fact import hot_keys

    n = 6000
    fact = spark.range(n).select(
        F.col("id").alias("eventid"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("g"), (F.col("id") % 40).cast("string"))).alias("g"))
    dim = spark.range(41).select(F.col("id").cast("int").alias("k"),
                                 F.when(F.col("id") == 40, F.lit("hot")).otherwise(
                                     F.concat(F.lit("g"), F.col("id").cast("string"))).alias("g"))
    spec = LookupSpec("G", "k", (("g", "g"),))
    hot = hot_keys(fact, [F.col("g")], share=0.05, fraction=0.5)
    assert ("hot",) in hot
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        salted = lookup(fact, dim, spec, 41, 200, hot=hot, salts=8)
        plan = _plan(salted)
        assert "SortMergeJoin" in plan and "xxhash64" in plan
        got = {r.eventid: r.k for r in salted.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plain = {r.eventid: r.k for r in lookup(fact, dim, spec, 41, 200).collect()}
    assert len(got) == n and got == plain
    assert got[0] == 40 and got[7] is None and got[1] == 1


def test_salted_lookup_mixed_key_types(spark):
    fact = spark.range(3000).select(F.col("id").alias("eventid"),
                                    F.when(F.col("id") % 2 == 0, F.lit(9.0)).otherwise((F.col("id") % 5).cast("double"))
                                    .alias("code"))
    dim = spark.range(10).select(F.col("id").cast("int").alias("k"), F.col("id").cast("short").alias("code"))
    spec = LookupSpec("C", "k", (("code", "code"),))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = {r.eventid: r.k for r in lookup(fact, dim, spec, 10, 0, hot=[(9.0,)], salts=4).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(got) == 3000 and got[0] == 9 and got[1] == 1 and got[3] == 3


def test_hot_keys_bound(spark):
    from dimloom.operators.fact import hot_keys

    uniform = spark.range(200000).select((F.col("id") % 5000).alias("g"))
    assert hot_keys(uniform, [F.col("g")], share=0.01, fraction=0.2) == []
    skewed = spark.range(200000).select(F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("g"))
    assert hot_keys(skewed, [F.col("g")], share=0.01, fraction=0.2) == [(-1,)]
    few = spark.range(100000).select((F.col("id") % 20).alias("g"))
    got = hot_keys(few, [F.col("g")], share=0.04, fraction=0.5)
    assert len(got) <= 25 and len(got) == 20


def test_hot_keys_of_all_lookups_in_one_pass(spark):
    """The same hot keys as one exact count for each lookup gives, from a single job's plan."""
    from dimloom.operators.fact import hot_keys, hot_lookup_keys

    fact = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, "a \"b\"").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("é"), (F.col("id") % 9000).cast("string"))).alias("g"),
        (F.col("id") % 60).cast("int").alias("c"), F.when(F.col("id") % 4 == 0, 0.1).otherwise(F.col("id") / 7).alias("x"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 2).alias("f"))
    specs = [LookupSpec("G", "k", (("g", "g"),)), LookupSpec("C", "k", (("c", "c"),)), LookupSpec("X", "k", (("x", "x"), ("f", "f"))),
             LookupSpec("F", "k", (("f", "f"),), defaults={0: 7})]
    got = hot_lookup_keys(fact, specs, share=0.05, fraction=0.5)
    exact = [hot_keys(fact, [s.fact_expr(i) for i in range(len(s.pairs))], share=0.05, fraction=0.5) for s in specs]
    assert [sorted(g) for g in got] == [sorted(tuple(str(v) for v in h) for h in e) for e in exact]
    assert [len(g) for g in got] == [1, 0, 1, 3] and hot_lookup_keys(fact, []) == [] and hot_lookup_keys(fact.limit(0), specs) == [[], [], [], []]


def test_collated_lookup_matches_whatever_case_and_trailing_spaces(spark):
    dim = spark.createDataFrame([(3, "Rome"), (1, "ROME "), (2, "paris"), (4, " oslo")], "k int, city string")
    fact = spark.createDataFrame([(i, c) for i, c in enumerate(["rome", "Rome   ", "PARIS", "oslo", None, "x"] * 40)], "eventid int, town string")
    spec = LookupSpec("D", "k", (("city", "town"),), collated=(0,))
    from dimloom.operators.fact import hot_lookup_keys

    hot = hot_lookup_keys(fact, [spec], share=0.1, fraction=1.0)[0]
    assert ("rome",) in hot
    for out in (lookup(fact, dim, spec, 4, 20), lookup(fact, dim, spec, None, hot=hot, salts=4)):
        got = {r.eventid % 6: r.k for r in out.collect()}
        assert got == {0: 1, 1: 1, 2: 2, 3: None, 4: None, 5: None} and out.count() == 240

"""Rows kept by their places, and what the fact's lookups shuffle."""

from dataclasses import replace

from pyspark.sql import functions as F

from dimloom.operators.fact import LookupSpec, dedupe, is_large, lookup, measured, resolve_star
from dimloom.operators.keys import Keyed
from dimloom.operators.places import first_rows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _written(spark, tmp_path, files=5):
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 1000 != 7, F.col("id") % 30_000).alias("k"), F.hash("id").alias("a"),
        F.when(F.col("id") % 11 > 0, F.col("id")).alias("b"), F.repeat(F.lit("wide"), 20).alias("note"))
    rows.repartition(files, "a").write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def test_first_rows_are_kept_where_they_lie(spark, tmp_path):
    table = _written(spark, tmp_path)
    for df in (table, table.where("b % 3 > 0").drop("note"), table.withColumn("k", F.concat(F.col("k").cast("string"), F.lit("x"))), table.where("a IS NULL")):
        kept, plain = dedupe(df, "k", ["a", "b"], written=True), dedupe(df, "k", ["a", "b"])
        assert kept.columns == df.columns
        assert kept.exceptAll(plain).isEmpty() and plain.exceptAll(kept).isEmpty()
        # rows aren't shuffled: what is left of the plan is a scan and a broadcast
        assert "hashpartitioning" not in _plan(kept) and "Window" not in _plan(kept)


def test_equal_rows_keep_one(spark, tmp_path):
    spark.range(50).select(F.lit(1).alias("k"), F.lit(2).alias("a")).repartition(3).write.parquet(str(tmp_path / "t"))
    assert dedupe(spark.read.parquet(str(tmp_path / "t")), "k", ["a"], written=True).count() == 1


def test_bitmaps_are_broadcast_within_a_bound(spark, tmp_path):
    table = _written(spark, tmp_path, 1)
    assert first_rows(table, ["k"], ["a", "b"], most_bytes=3 * 4096) is None  # four blocks
    assert first_rows(table, ["k"], ["a", "b"], most_bytes=4 * 4096) is not None
    assert first_rows(table, ["k"], ["a", "b"], may_broadcast=False) is None


def test_lookup_is_sized_by_its_reduced_side(spark, tmp_path):
    # many members share what the lookup matches
    dim = spark.range(20_000).select((F.col("id") + 1).cast("int").alias("k"), (F.col("id") % 10).cast("int").alias("code"), F.col("id").alias("other"))
    fact = spark.range(40).select(F.col("id").alias("eventid"), (F.col("id") % 12).cast("int").alias("code"))
    spec, keyed = LookupSpec("D", "k", (("code", "code"),)), Keyed(dim, 20_000, "k", 0, ("code", "other"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
        assert is_large(spark, keyed, spec)
        small = measured(spark, keyed, spec)
        assert (small.rows, small.text_bytes) == (10, 0)
        found = resolve_star(fact, {"D": keyed}, [spec], hot_source=fact)
        assert "BroadcastHashJoin" in _plan(found) and "SortMergeJoin" not in _plan(found)
        assert {r.eventid: r.k for r in found.collect()} == {i: i % 12 + 1 if i % 12 < 10 else None for i in range(40)}
        # a lookup on all natural columns joins the whole dimension: nothing to count
        whole = replace(spec, pairs=(("code", "code"), ("other", "eventid")))
        assert measured(spark, keyed, whole) is keyed
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_salted_lookup_reads_only_what_is_asked_for(spark):
    dim = spark.range(9).select(F.col("id").cast("int").alias("k"), F.col("id").cast("int").alias("code"))
    fact = spark.range(90).select(F.col("id").alias("eventid"), (F.col("id") % 9).cast("int").alias("code"), F.lit("x").alias("unread"))
    out = lookup(fact, dim, LookupSpec("D", "k", (("code", "code"),)), None, hot=[("1",)], salts=4, salt_on=("eventid",)).select("eventid", "k")
    assert "unread" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuple(r) for r in out.collect()) == [(i, i % 9) for i in range(90)]


def test_collated_lookup_sorts_texts_and_not_facts(spark):
    dim = spark.createDataFrame([(3, "Rome", 1), (1, "ROME ", 1), (2, "paris", 1), (4, " oslo", 1), (5, None, 1)], "k int, city string, land int")
    towns = ["rome", "Rome   ", "PARIS", "oslo", None, "x"]
    fact = spark.createDataFrame([(i, c, 1) for i, c in enumerate(towns * 40)], "eventid int, town string, land int")
    spec = LookupSpec("D", "k", (("city", "town"), ("land", "land")), collated=(0,))
    out = resolve_star(fact, {"D": Keyed(dim, 5, "k", 20)}, [spec], hot_source=fact, salt_on=("eventid",))
    assert "SortMergeJoin" not in _plan(out) and "BroadcastHashJoin" in _plan(out)
    want = {0: 1, 1: 1, 2: 2, 3: None, 4: None, 5: None}
    assert out.count() == 240 and {r.eventid % 6: r.k for r in out.collect()} == want
    assert out.schema["town"].dataType.simpleString() == "string"
    safe = lookup(fact, dim, replace(spec, null_safe=True))
    assert {r.eventid % 6: r.k for r in safe.collect()} == {**want, 4: 5}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:  # too many texts to broadcast: hot ones are salted as the facts write them
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        large = lookup(fact, dim, spec, 5, 20, hot=[])
        assert "SortMergeJoin" in _plan(large) and {r.eventid % 6: r.k for r in large.collect()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_new_members_are_joined_as_members(spark, tmp_path):
    # staging is read once, and the anti join does not meet its rows
    from dimloom.operators.dims import insert_new
    from dimloom.plans.specs import BY_NAME
    from dimloom.session import scratch_root

    spec = BY_NAME["DimRegion"]
    spark.range(4000).select((F.col("id") % 8).cast("int").alias("region"), F.format_string("r%d", F.col("id") % 8).alias("region_txt")).write.parquet(str(tmp_path / "s"))
    staging = spark.read.parquet(str(tmp_path / "s"))
    existing = spark.createDataFrame([(1, 0, "r0"), (2, 5, "r5")], "RegionKey int, region int, RegionName string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        fresh = insert_new(staging, spec, existing)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(tuple(r) for r in fresh.df.collect()) == [(k, c, f"r{c}") for k, c in ((3, 1), (4, 2), (5, 3), (6, 4), (7, 6), (8, 7))]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert any(f.getPath().getName().startswith("members-") for f in fs.listStatus(path))


def test_first_load_joins_no_empty_table(spark, tmp_path, monkeypatch):
    from dimloom.plans import warehouse as W
    from dimloom.plans.specs import BY_NAME

    def not_asked(*a, **b):
        raise AssertionError("nothing is there to be compared with")

    monkeypatch.setattr(W, "insert_new", not_asked)
    staging = spark.range(40).select((F.col("id") % 8).cast("int").alias("region"), F.lit("r").alias("region_txt"))
    wh = W.Warehouse(spark, str(tmp_path / "w"))
    for mode in ("insert_new", "if_empty"):
        got = W.load_dimension(W.Warehouse(spark, str(tmp_path / mode)), staging, BY_NAME["DimRegion"], mode)
        assert (got.status, got.rows) == (1, 8)
    assert wh.is_empty("DimRegion")


def test_first_fact_load_joins_nothing_and_replays_add_nothing(spark, tmp_path, monkeypatch):
    from dimloom.plans import warehouse as W

    ids = [f.name for f in W.SCHEMAS[W.FACT].fields]
    view = spark.range(30).select(F.col("id").cast("string").alias("EventID"), F.lit(19990101).alias("DateKey"), F.lit(1).alias("LocationKey"),
                                  *[F.lit(None).cast(W.SCHEMAS[W.FACT][c].dataType).alias(c) for c in ids[3:]])
    asked = []
    joined = W.load_fact
    monkeypatch.setattr(W, "fact_view", lambda *a, **b: view)
    monkeypatch.setattr(W, "load_fact", lambda *a, **b: (asked.append(1), joined(*a, **b))[1])
    wh = W.Warehouse(spark, str(tmp_path / "w"))
    first = W.load_fact_table(wh, view, [], [], [], [])
    assert (first.rows, asked) == (30, [])
    again = W.load_fact_table(wh, view, [], [], [], [])
    assert (again.rows, asked) == (0, [1]) and wh.table(W.FACT).count() == 30


def test_references_are_counted_by_number(spark):
    from dimloom.operators.audit import reference_violations

    fact = spark.createDataFrame([(1, 7), (2, None), (9, 8), (9, 7)], "a int, b int")
    dim, other = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(7,), (7,)], "k int")
    out = reference_violations(fact, [("a", "A", dim, "k", None), ("b", "B", other, "k", None)])
    assert out.columns == ["fk_column", "dimension", "checked_rows", "null_rows", "orphan_rows"]
    assert sorted(tuple(r) for r in out.collect()) == [("a", "A", 4, 0, 2), ("b", "B", 3, 1, 1)]
    # no names travel with the keys
    assert "posexplode" in out._jdf.queryExecution().executedPlan().toString()

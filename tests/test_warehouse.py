"""Warehouse: load modes run twice, whole run, log."""

import datetime as dt

from dimloom.plans.pipeline import WAREHOUSE_COLUMNS
from dimloom.plans.specs import BY_NAME, DEDUPE_ORDER, DIMENSIONS, FACT_COLUMNS, LOOKUPS
from dimloom.plans.warehouse import EtlLog, Warehouse, load_dimension, log_view, run_warehouse
from dimloom.sources.fixtures import raw_incidents

from paths import SF_TINY


def test_load_modes_twice(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    st = spark.createDataFrame([(1, "a"), (2, "b")], "country int, country_txt string")
    spec = BY_NAME["DimCountry"]
    assert load_dimension(wh, st, spec).rows == 2
    assert load_dimension(wh, st, spec).rows == 0          # second run adds nothing
    more = spark.createDataFrame([(3, "c"), (1, "a")], "country int, country_txt string")
    assert load_dimension(wh, more, spec).rows == 1
    keys = sorted((r.CountryKey, r.GTDCountryCode) for r in wh.table("DimCountry").collect())
    assert keys == [(1, 1), (2, 2), (3, 3)]
    first = load_dimension(wh, st, spec, mode="if_empty")
    assert first.status == 0
    assert load_dimension(wh, st, spec, mode="refresh").rows == 2 and wh.table("DimCountry").count() == 2


def test_log_and_view(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    log = EtlLog(wh)
    assert log.append("step", "done", dt.datetime(2025, 7, 24, 14, 5))
    assert log.append("step2", "done")
    rows = log_view(wh.table("ETLLog")).orderBy("ETLLogID").collect()
    assert rows[0].ETLDate == "Thursday, July 24, 2025" and rows[0].ETLTime == "14:05"
    assert [r.ETLLogID for r in rows] == [1, 2]


def test_whole_run_and_rerun(spark, tmp_path):
    root = str(tmp_path / "wh")
    raw = raw_incidents(spark, SF_TINY)
    args = (DIMENSIONS, LOOKUPS, FACT_COLUMNS, DEDUPE_ORDER)
    status = {r.step: r for r in run_warehouse(spark, raw, root, *args, protect=WAREHOUSE_COLUMNS).collect()}
    assert all(r.status >= 0 for r in status.values()), status
    fact_rows = status["Fact_Terror_Events"].rows
    assert fact_rows > 0 and status["DimDate"].rows == 73414
    wh = Warehouse(spark, root)
    fact = wh.table("Fact_Terror_Events")
    assert fact.count() == fact_rows == fact.select("EventID").distinct().count()
    again = {r.step: r for r in run_warehouse(spark, raw, root, *args, refresh=False,
                                              protect=WAREHOUSE_COLUMNS).collect()}
    assert again["Fact_Terror_Events"].rows == 0 and again["DimCountry"].rows == 0
    assert again["DimLocation"].status == 0 and again["DimDate"].status == 0
    assert wh.table("Fact_Terror_Events").count() == fact_rows
    assert wh.table("ETLLog").count() == len(status) + len(again)


def test_fact_rejects_out_of_range_dates(spark, tmp_path):
    from pyspark.sql import functions as F

    from dimloom.plans.warehouse import load_date_dimension, load_dimension, load_fact_table

    wh = Warehouse(spark, str(tmp_path / "wh"))
    raw = raw_incidents(spark, SF_TINY)
    from dimloom.operators.clean import clean

    staging = clean(raw, "rename").withColumn(
        "year", F.when(F.col("eventid") % 2 == 0, F.lit(1850)).otherwise(F.col("year")))
    load_date_dimension(wh)
    for spec in DIMENSIONS:
        load_dimension(wh, staging, spec)
    res = load_fact_table(wh, staging, DIMENSIONS, LOOKUPS, FACT_COLUMNS, DEDUPE_ORDER)
    rejected = int(res.message.rsplit(" ", 1)[-1])
    assert res.rows > 0 and rejected > 0
    fact = wh.table("Fact_Terror_Events")
    assert fact.where("DateKey IS NULL").count() == 0 and fact.count() == res.rows
    assert spark.read.parquet(f"{wh.root}/_rejects/Fact_Terror_Events/*").count() == rejected


def test_long_names_reload_adds_nothing(spark, tmp_path):
    """Cities and group names past their declared widths stay whole: every lookup still
    finds them, and a second load adds no members."""
    from pyspark.sql import functions as F

    from dimloom.operators.clean import clean
    from dimloom.plans.warehouse import load_date_dimension, load_fact_table

    wh = Warehouse(spark, str(tmp_path / "wh"))
    staging = clean(raw_incidents(spark, SF_TINY), "rename").withColumns({
        "city": F.when(F.col("tie1") % 2 == 0, F.concat("city", F.lit("x" * 250))).otherwise(F.col("city")),
        "gname": F.when(F.col("tie1") % 3 == 0, F.concat("gname", F.lit("y" * 300))).otherwise(F.col("gname"))})
    load_date_dimension(wh)
    for spec in DIMENSIONS:
        load_dimension(wh, staging, spec)
    res = load_fact_table(wh, staging, DIMENSIONS, LOOKUPS, FACT_COLUMNS, DEDUPE_ORDER)
    fact = wh.table("Fact_Terror_Events")
    assert res.message.endswith("rejected 0") and fact.count() == res.rows > 0
    assert fact.where("PerpetratorGroupKey IS NULL OR LocationKey IS NULL").count() == 0
    for name in ("DimLocation", "DimPerpetratorGroup"):
        assert load_dimension(wh, staging, BY_NAME[name], mode="insert_new").rows == 0


def test_bad_load_fails_the_key_audit(spark, tmp_path):
    from dimloom.plans.warehouse import audit_keys

    wh = Warehouse(spark, str(tmp_path / "wh"))
    run_warehouse(spark, raw_incidents(spark, SF_TINY), wh.root, DIMENSIONS, LOOKUPS, FACT_COLUMNS, DEDUPE_ORDER,
                  protect=WAREHOUSE_COLUMNS)
    assert [r.status for r in audit_keys(wh, DIMENSIONS)] == [1, 1, 1]
    wh.append("Fact_Terror_Events", wh.table("Fact_Terror_Events").limit(1).selectExpr("* except (CountryKey)", "-7 AS CountryKey"))
    assert [(r.step, r.status, r.rows) for r in audit_keys(wh, DIMENSIONS)] == [
        ("audit_references", -1, 1), ("audit_unique", -1, 1), ("audit_not_null", 1, 0)]


def test_versions_sort_by_number(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for v in ("v99999", "v100000"):
        spark.range(int(v[1:]) % 7).write.parquet(f"{wh.root}/t/{v}")
    assert wh.current_path("t").endswith("v100000")


def test_shared_folder_is_required_on_a_cluster():
    import pytest

    from dimloom.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):  # noqa: N802 -- Spark's name
            return None

    class Session:
        sparkContext = Context()  # noqa: N815 -- Spark's name

        class conf:  # noqa: N801 -- Spark's name
            @staticmethod
            def get(_, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def _small_staging(spark):
    from dimloom.operators.clean import clean

    return clean(raw_incidents(spark, SF_TINY), "rename")


def test_a_version_is_published_at_once_or_not_at_all(spark, tmp_path):
    wh, other = (Warehouse(spark, str(tmp_path / "wh")) for _ in range(2))
    rows = lambda n: spark.createDataFrame([(i, i, f"c{i}") for i in n], "CountryKey int, GTDCountryCode int, CountryName string")
    wh.publish("DimCountry", rows([1, 2]), ("GTDCountryCode",))
    wh.begin()
    wh.append("DimCountry", rows([3]), ("GTDCountryCode",))
    assert wh.table("DimCountry").count() == 3 and other.table("DimCountry").count() == 2
    assert [b.rows for b in wh.unpublished("DimCountry")] == [1] and other.unpublished("DimCountry") == ()
    wh.reset(["DimCountry"])
    assert wh.is_empty("DimCountry") and not other.is_empty("DimCountry")
    wh.rollback()
    assert wh.table("DimCountry").count() == 2
    wh.begin()
    wh.append("DimCountry", rows([3]), ("GTDCountryCode",))
    wh.commit()
    keyed = other.keyed("DimCountry")
    assert (keyed.rows, keyed.text_bytes, keyed.unique_on) == (3, 6, ("GTDCountryCode",))
    wh.append("DimCountry", rows([3]))  # no claim: the table has none from now on
    assert other.keyed("DimCountry").unique_on == () and other.keyed("DimCountry").rows == 4


def test_many_batches_are_merged(spark, tmp_path, monkeypatch):
    from dimloom.plans import warehouse

    monkeypatch.setattr(warehouse, "MOST_BATCHES", 3)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for i in range(7):
        wh.append("DimRegion", spark.createDataFrame([(i + 1, i, f"r{i}")], "RegionKey int, region int, RegionName string"), ("region",))
    assert len(wh.version("DimRegion").batches) <= 4 and wh.keyed("DimRegion").unique_on == ("region",)
    assert sorted(r.RegionKey for r in wh.table("DimRegion").collect()) == list(range(1, 8)) and wh.keyed("DimRegion").rows == 7


def test_load_opens_only_parts_that_may_hold_its_ids(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from dimloom.operators import membership
    from dimloom.plans.warehouse import FACT, load_date_dimension, load_fact_table
    from dimloom.sources.contracts import SCHEMAS

    monkeypatch.setattr(membership, "PART_KEYS", 300)
    monkeypatch.setattr(membership, "BLOCK_KEYS", 50)
    wh, staging = Warehouse(spark, str(tmp_path / "wh")), _small_staging(spark)
    load_date_dimension(wh)
    for spec in DIMENSIONS:
        load_dimension(wh, staging, spec)
    third = lambda n: staging.where(F.col("eventid") % 3 == n)
    load = lambda df: load_fact_table(wh, df, DIMENSIONS, LOOKUPS, FACT_COLUMNS, DEDUPE_ORDER)
    opened = lambda res: tuple(int(x) for x in res.message.split(": ")[1].split(";")[0].split(" of "))
    first, second = load(third(0)), load(third(1))
    assert opened(first) == (0, 0) and first.rows > 600 and second.rows > 600
    assert opened(second)[0] <= 2 < opened(second)[1]  # of new ids about 1 in 2,000 seems known
    one = wh.table(FACT).select(F.col("EventID").cast("long").alias("eventid")).limit(1)
    again = load(staging.join(one, "eventid", "left_semi"))
    assert again.rows == 0 and opened(again)[0] in (1, 2)
    whole = load(staging)
    total = wh.table(FACT)
    assert whole.rows > 0 and total.count() == total.select("EventID").distinct().count() == first.rows + second.rows + whole.rows
    assert opened(whole)[0] == opened(whole)[1]
    assert total.schema.names == SCHEMAS[FACT].names


def test_load_joins_unique_dimensions_as_they_are(spark, tmp_path):
    from dimloom.operators.fact import fact_view

    wh, staging = Warehouse(spark, str(tmp_path / "wh")), _small_staging(spark)
    for spec in DIMENSIONS:
        load_dimension(wh, staging, spec)
    dims = {spec.name: wh.keyed(spec.name) for spec in DIMENSIONS}
    assert sum(bool(d.unique_on) for d in dims.values()) == 16  # all but the location, which is looked up by a part of its key
    plan = fact_view(staging, dims, LOOKUPS, FACT_COLUMNS, DEDUPE_ORDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "min(LocationKey" in plan


def test_a_run_with_orphans_publishes_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    root, raw = str(tmp_path / "wh"), raw_incidents(spark, SF_TINY)
    args = (DIMENSIONS, LOOKUPS)
    run_warehouse(spark, raw.where("iyear < 1998"), root, *args, FACT_COLUMNS, DEDUPE_ORDER, protect=WAREHOUSE_COLUMNS)
    wh = Warehouse(spark, root)
    before = {t: wh.current_path(t) for t in ("Fact_Terror_Events", "DimCountry", "DimDate")}
    rows = wh.table("Fact_Terror_Events").count()
    planted = [c if c != "CountryKey" else F.when(F.col("eventid") % 10 == 3, -7).otherwise(F.col(c)).alias(c) for c in FACT_COLUMNS]
    for refresh in (True, False):
        got = {r.step: r for r in run_warehouse(spark, raw, root, *args, planted, DEDUPE_ORDER, refresh=refresh, protect=WAREHOUSE_COLUMNS).collect()}
        assert got["audit_references"].status == got["Fact_Terror_Events"].status == -1 and got["audit_references"].rows > 0
        assert got["audit_unique"].status == got["audit_not_null"].status == 1
        assert {t: wh.current_path(t) for t in before} == before and wh.table("Fact_Terror_Events").count() == rows

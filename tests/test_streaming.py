"""Structured Streaming incremental load: two landed batches, then a replay."""

import uuid

from pyspark.sql import functions as F

from dimloom.plans.pipeline import WAREHOUSE_COLUMNS
from dimloom.plans.specs import DEDUPE_ORDER, DIMENSIONS, FACT_COLUMNS, LOOKUPS
from dimloom.plans.warehouse import Warehouse
from dimloom.sources.fixtures import raw_incidents
from dimloom.streaming.incremental import start_incremental_load

from paths import SF_TINY


def test_two_batches_then_nothing(spark, tmp_path):
    raw = raw_incidents(spark, SF_TINY)
    landing, root = str(tmp_path / "landing"), str(tmp_path / "wh")
    raw.where(F.col("iyear") < 1998).write.parquet(f"{landing}/part1")
    args = dict(specs=DIMENSIONS, lookups=LOOKUPS, columns=FACT_COLUMNS, order_by=DEDUPE_ORDER,
                protect=WAREHOUSE_COLUMNS, name=f"t{uuid.uuid4().hex[:8]}")
    q = start_incremental_load(spark, f"{landing}/*", raw.schema, root, **args)
    q.awaitTermination()
    wh = Warehouse(spark, root)
    first = wh.table("Fact_Terror_Events").count()
    assert first > 0
    raw.where(F.col("iyear") >= 1998).write.parquet(f"{landing}/part2")
    q = start_incremental_load(spark, f"{landing}/*", raw.schema, root, **args)
    q.awaitTermination()
    fact = wh.table("Fact_Terror_Events")
    total = fact.count()
    assert total > first and fact.select("EventID").distinct().count() == total
    keys = wh.table("DimLocation").select("LocationKey").collect()
    assert sorted(r[0] for r in keys) == list(range(1, len(keys) + 1))
    q = start_incremental_load(spark, f"{landing}/*", raw.schema, root, **args)
    q.awaitTermination()
    assert wh.table("Fact_Terror_Events").count() == total

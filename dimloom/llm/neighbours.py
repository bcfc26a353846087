"""Pairing each row with the next one in a global order, without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions
from .url_rules import slot

#: Sampled keys for each range.
SAMPLED = 20


def in_ranges(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows in descending order of `key` (nulls last) within ranges, each range followed by the first row of the next.

    Adds _range, and _tail: true for the copied row that ends a range (the last range ends with the very first row). Rows
    of a range are in one partition, sorted. Bounds come from a sample of fixed size for each range; the heads of the
    ranges (one key each) are looked up on the driver."""
    n = partitions(df)
    ranges = min(2000, 4 * n)
    at = F.struct(*key)
    sample = df.select(at.alias("k"), F.xxhash64(*key).alias("h")).orderBy("h").limit(SAMPLED * ranges).select("k").collect()
    kinds = [df.schema[c].dataType.simpleString() for c in key]
    none = lambda k: tuple((v is not None, v) for v in k)
    got = sorted((tuple(r["k"]) for r in sample), key=none)
    bounds = sorted({got[i * len(got) // ranges] for i in range(1, ranges)}, key=none) if got else []
    lit = lambda k: F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(k, kinds, key, strict=True)])
    ranged = df.withColumn("_range", slot(at, [lit(b) for b in bounds]))
    heads = ranged.groupBy("_range").agg(F.max(at).alias("_head")).select("_range", "_head")
    order = sorted(r[0] for r in heads.select("_range").collect())  # one number a range
    goes = {r: order[(i + 1) % len(order)] for i, r in enumerate(order)}
    if not goes:
        return ranged.withColumn("_tail", F.lit(False))
    up = F.create_map(*[x for k, v in goes.items() for x in (F.lit(k), F.lit(v))])
    heads = heads.withColumn("_up", F.element_at(up, F.col("_range")))  # at most `ranges` rows
    ranged = ranged.join(F.broadcast(heads), "_range")
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("t"))
    copy = F.struct(F.col("_up").alias("r"), F.lit(True).alias("t"))
    both = F.when(at == F.col("_head"), F.array(own, copy)).otherwise(F.array(own))
    rows = ranged.select(*df.columns, F.explode(both).alias("_to")).select(*df.columns, F.col("_to.r").alias("_range"), F.col("_to.t").alias("_tail"))
    down: list[Column] = [F.col(c).desc_nulls_last() for c in key]
    return rows.repartition(n, "_range").sortWithinPartitions("_range", "_tail", *down)

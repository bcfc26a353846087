"""Surrogate keys (K1, K2) and key reduction (A2).

Dense keys 1..n in a fixed order, from one range sort and no single-partition window:

1. sort the rows by range (sampled bounds, one shuffle) and write them once: the files of the
   written table, in the order of their numbers, hold the rows in order;
2. count rows and text bytes by file (one row per file reaches the driver) and turn the counts
   into cumulative offsets;
3. a row's key is its file's offset (a broadcast join with one row per file) plus its place
   in the file.

The result equals a global ``row_number() OVER (ORDER BY ...)`` wherever the bounds fall,
provided the ordering is total (dimension members are distinct). Keys are read off the
written files, so a recomputation after a lost executor yields the same keys.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.session import new_scratch_path

# Rows per range: None leaves the number of ranges to the session's shuffle partitions.
DEFAULT_BUCKET_ROWS = None
MAX_BUCKETS = 4096


@dataclass
class Keyed:
    """A keyed table, its exact row count and total text bytes (a size bound)."""

    df: DataFrame
    rows: int
    key: str
    text_bytes: int | None = None
    # Columns of which no two rows agree in all (empty: not known).
    unique_on: tuple[str, ...] = ()


def size_aggregates(df: DataFrame) -> list:
    """Row count and total UTF-8 bytes of all text columns, as aggregates."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text), F.lit(0))
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("b")]


def size_stats(df: DataFrame) -> tuple[int, int]:
    """(rows, total UTF-8 bytes of all text columns) in one aggregation."""
    row = df.agg(*size_aggregates(df)).first()
    return int(row["n"]), int(row["b"])


def _names(order_by) -> list[str]:
    if not all(isinstance(c, str) for c in order_by):
        raise TypeError("order_by must name columns")
    return list(order_by)


def bucket_count(rows: int, bucket_rows: int) -> int:
    return max(1, min(MAX_BUCKETS, math.ceil(rows / max(1, bucket_rows))))


def _file_number(name: str) -> tuple[int, str]:
    """Order of a sorted table's files: the number of the writing task, then that of its file."""
    return int(re.match(r"part-(\d+)", name).group(1)), name


@dataclass
class Numbered:
    """A table written in sorted order, with its rows' places."""

    df: DataFrame
    rows: int
    text_bytes: int


def number_rows(df: DataFrame, order_by, place: str, ranges: int | None = None) -> Numbered:
    """Write df sorted by ``order_by`` and add ``place`` = 0, 1, 2, ... (long) in that order.

    ``ranges``: how many ranges to sort by (None: the session's shuffle partitions,
    small ones merged by AQE). Rows that agree in all of ``order_by`` come in any order,
    which is fixed from then on."""
    names = _names(order_by)
    spark = df.sparkSession
    path = new_scratch_path(spark, "sorted")
    ordered = df.orderBy(*names) if ranges is None else df.repartitionByRange(ranges, *names).sortWithinPartitions(*names)
    ordered.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    rows = written.withColumns({"__file": F.col("_metadata.file_name"), place: F.col("_metadata.row_index")})
    files = sorted(rows.groupBy("__file").agg(*size_aggregates(df)).collect(), key=lambda r: _file_number(r["__file"]))
    starts, total = [], 0
    for r in files:
        starts.append(total)
        total += r["n"]
    text_bytes = sum(int(r["b"]) for r in files)
    if len(files) > 1:
        offsets = spark.createDataFrame(pa.table({"__file": [r["__file"] for r in files], "__start": pa.array(starts, pa.int64())}))
        rows = rows.join(F.broadcast(offsets), "__file").withColumn(place, F.col("__start") + F.col(place))
    return Numbered(rows.select(*df.columns, place), total, text_bytes)


def assign_keys(df: DataFrame, order_by, key: str, start: int = 0,
                bucket_rows: int | None = DEFAULT_BUCKET_ROWS, rows: int | None = None, key_type: str = "int") -> Keyed:
    """K1: add ``key`` = start + 1, start + 2, ... in ``order_by`` order.

    ``order_by`` must be a total order over the rows of ``df``. ``bucket_rows`` asks for
    ranges of about so many rows (``rows``, if known, spares the count that this takes).
    """
    ranges = None
    if bucket_rows is not None:
        ranges = bucket_count(df.count() if rows is None else rows, bucket_rows)
    numbered = number_rows(df, order_by, "__place", ranges)
    keyed = numbered.df.select((F.col("__place") + F.lit(start + 1)).cast(key_type).alias(key), *df.columns)
    return Keyed(keyed, numbered.rows, key, numbered.text_bytes)


def max_key(df: DataFrame, key: str) -> int:
    """Largest existing key, 0 for an empty table (one aggregate row)."""
    value = df.agg(F.max(key)).first()[0]
    return int(value) if value is not None else 0


def continue_keys(new: DataFrame, existing: DataFrame, order_by, key: str,
                  bucket_rows: int | None = DEFAULT_BUCKET_ROWS) -> Keyed:
    """K2: number new members after the largest existing key."""
    return assign_keys(new, order_by, key, start=max_key(existing, key), bucket_rows=bucket_rows)


def unique_keys(dim: DataFrame, on, key: str) -> DataFrame:
    """A2: one key per natural key -- the smallest (partial + final aggregate)."""
    on = [on] if isinstance(on, str) else list(on)
    return dim.groupBy(*on).agg(F.min(key).alias(key))

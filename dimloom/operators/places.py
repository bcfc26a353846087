"""Rows of a written table by their places (W1): which rows are first of their key, as one bit a row.

A row's place is its file and its number in it. Only keys, order and places are shuffled to find
the first rows; their places become bitmaps, one for each block of a file, which are written and
broadcast, and the table is read again with the other rows left out. So wide rows are
never shuffled or sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimloom.session import new_scratch_path

# Rows of a block: the bits of one of Spark's bitmaps.
BLOCK_ROWS = 32768
# Bitmaps are broadcast up to so many bytes (a billion rows); beyond, the rows are shuffled.
MOST_BYTES = 128 << 20


def _file() -> Column:
    return F.xxhash64(F.col("_metadata.file_path"))


def _block(row: Column) -> Column:
    return F.floor(row / BLOCK_ROWS)


def first_rows(df: DataFrame, keys: list[str], order_by: list, may_broadcast: bool = True,
               most_bytes: int = MOST_BYTES) -> DataFrame | None:
    """The first row of each key, or None where the bitmaps would be too large to broadcast.

    ``df`` reads one written table by projections and filters only. Rows that agree in key and
    order are told apart by their places, so the same one is kept whenever it is read."""
    if not may_broadcast:
        return None
    row = F.col("_metadata.row_index")
    files = df.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.max(row).alias("last"))
    known = files.agg(F.count("f").alias("files"), F.count_distinct(F.xxhash64("f")).alias("hashes"),
                      F.sum(_block(F.col("last")) + 1).alias("blocks")).first()
    if known["files"] != known["hashes"] or (known["blocks"] or 0) * (BLOCK_ROWS // 8) > most_bytes:
        return None
    named = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    orders = [(F.col(o) if isinstance(o, str) else o) for o in order_by]
    w = Window.partitionBy(*[f"__k{i}" for i in range(len(keys))]).orderBy(*orders, "__file", "__row")
    places = df.withColumns({"__file": _file(), "__row": row}).select(*df.columns, *named, "__file", "__row")
    first = places.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1)
    # A block's places meet before they are folded: a bitmap for each task and block would be larger than the places.
    spread = first.select("__file", _block(F.col("__row")).alias("__block"), (F.col("__row") % BLOCK_ROWS).alias("__bit"))
    # bitmap_bit_position counts from 1
    bits = spread.repartition("__file", "__block").groupBy("__file", "__block").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("__bit") + 1)).alias("bits"))
    path = new_scratch_path(df.sparkSession, "first")
    # as an array of bytes, each is read without a search
    byte = lambda i: F.conv(F.hex(F.substring("bits", i, F.lit(1))), 16, 10).cast("int")
    signed = F.transform(F.sequence(F.lit(1), F.lit(BLOCK_ROWS // 8)), lambda i: (((byte(i) + 128) % 256) - 128).cast("byte"))
    bits.select("__file", "__block", signed.alias("bytes")).write.parquet(path)
    kept = F.broadcast(df.sparkSession.read.parquet(path).withColumnsRenamed({"__file": "__f", "__block": "__b"}))
    rows = df.withColumns({"__file": _file(), "__row": row})
    bit = F.col("__row") % BLOCK_ROWS
    is_set = F.getbit(F.get("bytes", F.floor(bit / 8).cast("int")), (bit % 8).cast("int")) == 1
    same = (F.col("__file") == F.col("__f")) & (_block(F.col("__row")) == F.col("__b"))
    return rows.join(kept, same & is_set, "left_semi").select(*df.columns)

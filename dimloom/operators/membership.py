"""Which parts of a written table may hold a row's key: Bloom filters of built-in functions.

The hash of a key names one block of bits, and a few bits in it. The blocks of a batch
are the rows of a small table, written beside it; a range of blocks is a part, a folder of
the batch. To find the parts that may hold some keys, each key is joined with one block
of each batch: no key is compared with rows, and a key that is in no batch opens a
part only if all of its bits are set by others (about 1 in 2,000).

Built and read with grouping, a join and bitmap functions; nothing reaches the driver
but the names of the parts to open, of which there are no more than folders.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bits of a block (what one bitmap of Spark's holds), keys a block is made for, bits set for a key.
BLOCK_BITS = 32768
BLOCK_KEYS = 2048
KEY_BITS = 8
# Keys a part is made for.
PART_KEYS = 1 << 20


@dataclass(frozen=True)
class Members:
    """The filter of a batch over ``column``: ``blocks`` rows in ``path``, and how the batch is split."""

    PART: ClassVar[str] = "id_part"

    column: str
    blocks: int
    parts: int
    path: str

    @classmethod
    def sized(cls, column: str, rows: int, path: str) -> Members:
        blocks = max(1, -(-rows // BLOCK_KEYS))
        return cls(column, blocks, min(blocks, max(1, -(-rows // PART_KEYS))), path)

    def block(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.blocks))

    def part(self, block: Column) -> Column:
        return F.floor(block * self.parts / self.blocks)

    def split(self, df: DataFrame) -> DataFrame:
        """df with its part, each part's rows in one task."""
        named = df.withColumn(self.PART, self.part(self.block(F.col(self.column))))
        return named.repartition(self.parts, self.PART)

    def write(self, df: DataFrame) -> None:
        """The blocks of df's keys."""
        key = F.col(self.column)
        bits = df.select(self.block(key).alias("block"), F.explode(key_bits(key)).alias("bit"))
        # bitmap_bit_position counts from 1
        made = bits.groupBy("block").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bits"))
        made.write.parquet(self.path)


def key_bits(key: Column) -> Column:
    """The bits of a key within its block."""
    return F.transform(F.sequence(F.lit(1), F.lit(KEY_BITS)), lambda i: F.pmod(F.xxhash64(F.lit(7), key, i), F.lit(BLOCK_BITS)))


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def held_parts(spark: SparkSession, incoming: DataFrame, rows: int | None, batches: list[tuple[str, Members]]) -> list[str]:
    """Folders of those parts of ``batches`` (path, filter) that may hold a key of ``incoming``.

    ``rows``: how many rows ``incoming`` has at most; where its keys' hashes fit a broadcast, the filters
    aren't shuffled. Rows with a NULL key are in no part."""
    from dimloom.operators.fact import fits_broadcast

    if not batches:
        return []
    column = batches[0][1].column
    key = F.col(column)
    each = F.array(*[F.struct(F.lit(i).alias("batch"), m.block(key).alias("block"), m.part(m.block(key)).alias("part")) for i, (_, m) in enumerate(batches)])
    wanted = incoming.where(key.isNotNull()).select(key_bits(key).alias("wanted"), F.explode(each).alias("w"))
    wanted = wanted.select("wanted", "w.*")
    # an array of KEY_BITS longs counts as so many columns
    schema = spark.range(0).select(*[F.lit(0).cast("long").alias(f"c{i}") for i in range(KEY_BITS + 5)]).schema
    if fits_broadcast(spark, None if rows is None else rows * len(batches), schema):
        wanted = F.broadcast(wanted)
    filters = None
    for i, (_, m) in enumerate(batches):
        one = spark.read.schema("block long, bits binary").parquet(m.path).withColumn("batch", F.lit(i))
        filters = one if filters is None else filters.unionByName(one)
    tested = filters.join(wanted, ["batch", "block"]).where(F.forall("wanted", lambda bit: _is_set(F.col("bits"), bit)))
    found = tested.select("batch", "part").distinct().collect()
    return sorted(f"{batches[r['batch']][0]}/{Members.PART}={r['part']}" for r in found)

"""File and database sources and sinks.

Paths are Hadoop URIs (local paths, ``file:``, object stores...); nothing here
touches the driver's local disk directly.
"""

from __future__ import annotations

import decimal
import math
import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text read as NULL from CSV (the usual default set of a
# dataframe CSV reader).
CSV_NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                   "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                   "nan", "null")


def read_incidents(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   encoding: str = "ISO-8859-1", null_tokens=None, multi_line: bool = True) -> DataFrame:
    """A headed CSV file (or folder) in the given encoding; quoted
    fields may hold newlines and doubled quotes. ``schema=None`` finds the types with one
    more pass over the data (``infer_types``). ``multi_line=False``,
    for files whose fields hold no newline, lets Spark split a file over tasks.
    """
    reader = (spark.read.option("header", True).option("encoding", encoding)
              .option("multiLine", multi_line).option("quote", '"').option("escape", '"')
              .option("mode", "PERMISSIVE"))
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    tokens = CSV_NULL_TOKENS if null_tokens is None else tuple(null_tokens)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    if tokens:
        df = df.select(*[F.when(F.col(f"`{c}`").isin(*tokens), None).otherwise(F.col(f"`{c}`")).alias(c) if c in text
                         else F.col(f"`{c}`") for c in df.columns])
    if schema is not None:
        return df
    found = {r["column_name"]: r["data_type"] for r in infer_types(df).collect()}  # one row a column
    return df.select(*[F.col(f"`{c}`").try_cast(found[c]).alias(c) for c in df.columns])


# Texts of each type that a column may have, from the narrowest up: int < bigint < double, date < timestamp, boolean.
# A column has the first type that holds all of its values, else it stays text.
_TYPE_PATTERNS = (
    ("int", r"^[+-]?\d+$"), ("bigint", r"^[+-]?\d+$"), ("double", r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"),
    ("date", r"^\d{4}-\d{2}-\d{2}$"), ("timestamp", r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"),
    ("boolean", r"^([tT][rR][uU][eE]|[fF][aA][lL][sS][eE])$"),
)


# Patterns as they are tried on a value, with the types whose texts are among those that fit (bigints are numbers, dates timestamps).
_TRIED = (("int", ("int", "bigint", "double")), ("double", ("double",)), ("date", ("date", "timestamp")), ("timestamp", ("timestamp",)), ("boolean", ("boolean",)))


def type_bits(value: Column) -> Column:
    """The types of a text as bits, in the order of ``_TYPE_PATTERNS``; NULL for NULL."""
    patterns, place = dict(_TYPE_PATTERNS), {kind: i for i, (kind, _) in enumerate(_TYPE_PATTERNS)}
    bits = F.when(value.isNull(), F.lit(None).cast("int"))
    for name, kinds in _TRIED:
        fits = [F.when(value.try_cast(k).isNotNull(), F.lit(1 << place[k])).otherwise(0) for k in kinds]
        bits = bits.when(value.rlike(patterns[name]), reduce(operator.add, fits))
    return bits.otherwise(0)


def infer_types(texts: DataFrame) -> DataFrame:
    """The type of each text column, as rows (position, column_name, data_type, non_null_rows).

    All columns are folded in one aggregation: a value's types are the bits of a number, a column's those that all of
    its values have. So it is one pass with partial aggregation and one buffer a column, whatever the number of types,
    and a value is held against further patterns only until one fits. NULLs count for no type; a column of NULLs is text."""
    aggs = []
    for i, c in enumerate(texts.columns):
        aggs += [F.count(F.col(f"`{c}`")).alias(f"n{i}"), F.bit_and(type_bits(F.col(f"`{c}`"))).alias(f"t{i}")]
    one = texts.agg(*aggs)
    found = []
    for i, c in enumerate(texts.columns):
        kind = F.coalesce(*[F.when(F.col(f"t{i}").bitwiseAND(1 << j) != 0, F.lit(k)) for j, (k, _) in enumerate(_TYPE_PATTERNS)], F.lit("string"))
        found.append(F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column_name"), kind.alias("data_type"), F.col(f"n{i}").alias("non_null_rows")))
    return one.select(F.explode(F.array(*found)).alias("c")).select("c.*")


def write_clean(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists",
                encoding: str = "UTF-8", compression: str = "none") -> None:
    """Write a cleaned table; CSV gets a header and quotes every text value
    that needs it. The output is a folder of part files, one per task; ``compression``
    names a codec for them (``read_incidents`` knows it by the files' names)."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = (writer.option("header", True).option("encoding", encoding)
                  .option("quote", '"').option("escape", '"').option("quoteAll", False)
                  .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
                  .option("compression", compression))
        writer.csv(path)
    else:
        writer.format(fmt).save(path)


def write_quarantine(tagged: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Bad rows, one sub-folder per offending column (``bad_column=<name>``).

    ``tagged`` comes from ``audit.bad_rows``; a column without bad rows simply
    gets no folder, so nothing is written for clean columns.
    """
    writer = tagged.write.mode(mode).partitionBy("bad_column")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def profile_schema(df: DataFrame) -> DataFrame:
    """The schema as rows (position, column_name, data_type, nullable)."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
               properties: dict[str, str] | None = None) -> None:
    """Write a table over JDBC (credentials come from ``properties``, never code).

    ``mode='overwrite'`` with ``truncate=true`` keeps the target's definition.
    """
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
              split_on: str | None = None, slices: int | None = None) -> DataFrame:
    """A table over JDBC. One task reads it, unless ``split_on`` names a number, date or timestamp column:
    its bounds are asked for first, and each of ``slices`` tasks (the default parallelism if not given) reads a range of
    it. Every row is in one range: the outer ones are open, and rows without a value are in the first."""
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    whole = reader.option("dbtable", table).load()
    slices = slices or spark.sparkContext.defaultParallelism
    if split_on is None or slices < 2:
        return whole
    split_on = next(c for c in whole.columns if c.lower() == split_on.lower())
    column = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(split_on)
    ends = reader.option("dbtable", f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) ends").load().first()
    lo, hi = (ends[0], ends[1])
    if lo is None or lo == hi:
        return whole
    # whole bounds: a range's ends are only where it is cut
    lo, hi = (math.floor(lo), math.ceil(hi)) if isinstance(lo, (int, float, decimal.Decimal)) else (lo, hi)
    return (reader.option("dbtable", table).option("partitionColumn", split_on).option("lowerBound", str(lo))
            .option("upperBound", str(hi)).option("numPartitions", slices).load())

"""Tables are marked for broadcast by their bytes as well as by their rows."""

import pytest
from pyspark.sql import functions as F

from dimloom.llm.common import small


def marked(df):
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("column", ["text", "array(text)", "array(struct(id, text))", "struct(id, text)", "sequence(id * 0, id * 0 + 9999)", "cast(text as binary)"])
def test_long_rows_are_not_broadcast(spark, column):
    df = spark.range(20).withColumn("text", F.repeat(F.lit("é"), 5000)).select("id", F.expr(column).alias("wide"))
    assert marked(small(df, 100, 3_000_000)) and not marked(small(df, 100, 150_000))
    assert not marked(small(df, 19))


def test_nulls_and_empty_tables_are_small(spark):
    df = spark.createDataFrame([(None, None, None)], "a string, b array<long>, c struct<d: array<string>>")
    assert marked(small(df)) and marked(small(df.limit(0)))
    assert not marked(small(df, 5, 10))

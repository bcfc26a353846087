"""CSV files: compressed copies, and types found with one buffer a column."""

from pyspark.sql import functions as F

from dimloom.sources.files import infer_types, read_incidents, type_bits, write_clean


def test_types_take_one_buffer_a_column(spark):
    texts = spark.createDataFrame([("1", "9999999999", "1.5", "2020-01-31", "2020-02-30", "TRUE", None, "x"),
                                   ("+2", "3", "-.5e3", "2020-01-31", "2020-02-01", "false", None, "1")],
                                  "a string, b string, c string, d string, e string, f string, g string, h string")
    found = infer_types(texts)
    assert [r["data_type"] for r in found.orderBy("position").collect()] == [
        "int", "bigint", "double", "date", "string", "boolean", "string", "string"]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("bit_and(") == len(texts.columns)
    mixed = spark.createDataFrame([("2020-01-31",), ("2020-01-31 10:00",), ("9" * 25,)], "v string").select(type_bits(F.col("v")).alias("b"))
    assert [r["b"] for r in mixed.collect()] == [8 + 16, 16, 4]


def test_compressed_csv_is_read_back(spark, tmp_path):
    df = spark.createDataFrame([("a\n\"b\"", "é"), ("c,d", " ")], "x string, y string")
    path = str(tmp_path / "csv")
    write_clean(df, path, "csv", encoding="ISO-8859-1", compression="snappy")
    assert list((tmp_path / "csv").glob("part-*.csv.snappy"))
    back = read_incidents(spark, path, schema=df.schema, encoding="ISO-8859-1")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))

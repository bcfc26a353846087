"""Sources and sinks: CSV edge cases (S1, S2, T13), quarantine folders (S7),
schema profile (S4), JDBC (S8), contracts (P17)."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.operators import audit as A
from dimloom.sources.contracts import SCHEMAS, conform
from dimloom.sources.files import infer_types, profile_schema, read_incidents, read_jdbc, write_clean, write_jdbc, write_quarantine


def test_csv_quotes_newlines_latin1(spark, tmp_path):
    path = tmp_path / "in.csv"
    text = 'eventid,city,summary\n1,"Bogot\xe1","line one\nline ""two"""\n2,NA,\n3, pad ,x\n'
    path.write_bytes(text.encode("latin-1"))
    schema = T.StructType([T.StructField("eventid", T.LongType()), T.StructField("city", T.StringType()),
                           T.StructField("summary", T.StringType())])
    rows = {r.eventid: r for r in read_incidents(spark, str(path), schema).collect()}
    assert len(rows) == 3
    assert rows[1].city == "Bogotá" and rows[1].summary == 'line one\nline "two"'
    assert rows[2].city is None and rows[2].summary is None
    assert rows[3].city == " pad "
    inferred = read_incidents(spark, str(path))
    assert dict(inferred.dtypes)["eventid"] in ("int", "bigint")


def test_csv_round_trip_keeps_padding(spark, tmp_path):
    df = spark.createDataFrame([(1, " a ", None), (2, "", "x,y")], "id int, s string, t string")
    out = str(tmp_path / "out")
    write_clean(df, out, "csv")
    back = {r.id: r for r in read_incidents(spark, out, df.schema, encoding="UTF-8").collect()}
    assert back[1].s == " a " and back[1].t is None and back[2].s is None and back[2].t == "x,y"


def test_quarantine_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", "1"), (2, "2", "y"), (3, "3", "4")], "id int, a string, b string")
    out = str(tmp_path / "q")
    write_quarantine(A.bad_rows(df, ["a", "b"]), out)
    assert sorted(d for d in os.listdir(out) if d.startswith("bad_column=")) == ["bad_column=a", "bad_column=b"]


def test_schema_profile(spark):
    df = spark.createDataFrame([(1, "x")], "id int, s string")
    got = [(r.position, r.column_name, r.data_type) for r in profile_schema(df).collect()]
    assert got == [(1, "id", "int"), (2, "s", "string")]


def test_jdbc_overwrite_and_append(spark):
    url = "jdbc:derby:memory:dimloom_test;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    write_jdbc(df, url, "STAGING", "overwrite", props)
    write_jdbc(df.limit(1), url, "STAGING", "append", props)
    assert read_jdbc(spark, url, "STAGING", props).count() == 3
    write_jdbc(df, url, "STAGING", "overwrite", {**props, "truncate": "true"})
    assert read_jdbc(spark, url, "STAGING", props).count() == 2


def test_conform_casts_and_widths(spark):
    df = spark.createDataFrame([(123456789012, 1.9, "x" * 300)], "EventID long, DateKey double, extra string")
    schema = T.StructType([T.StructField("EventID", T.StringType(), False), T.StructField("DateKey", T.IntegerType()),
                           T.StructField("Missing", T.IntegerType(), True)])
    row = conform(df, schema, {"EventID": 5}).collect()[0]
    assert row.EventID == "12345" and row.DateKey == 1 and row.Missing is None
    assert set(SCHEMAS) >= {"DimDate", "Fact_Terror_Events", "DimLocation", "ETLLog"}


def test_jdbc_read_in_slices(spark):
    url, props = "jdbc:derby:memory:dimloom_slices;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = [(None if i % 10 == 0 else i * i, dt.date(2020, 1, 1) + dt.timedelta(days=i), i / 7 - 3, f"n{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "id int, day date, x double, name string")
    write_jdbc(df, url, "STAGING", "overwrite", props)
    for column in ("id", "day", "x"):
        got = read_jdbc(spark, url, "STAGING", props, column, 4)
        assert got.rdd.getNumPartitions() == 4 and sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    sizes = [len(p) for p in read_jdbc(spark, url, "STAGING", props, "day", 4).rdd.glom().collect()]
    assert min(sizes) >= 20
    assert read_jdbc(spark, url, "STAGING", props).rdd.getNumPartitions() == 1
    write_jdbc(df.limit(0), url, "EMPTY_ONE", "overwrite", props)
    assert read_jdbc(spark, url, "EMPTY_ONE", props, "id", 4).count() == 0
    write_jdbc(df.limit(1).withColumn("id", F.lit(5)), url, "ONE", "overwrite", props)
    assert read_jdbc(spark, url, "ONE", props, "id", 4).count() == 1


def test_types_found_in_one_pass(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("i,l,d,day,ts,b,mixed,none,big,a.b\n" + "\n".join([
        "1,30000000000,1.5,2020-01-31,2020-01-31 10:00:00,true,1,NA,99999999999999999999,7",
        "NA,5,2,2019-12-01,2019-12-01,FALSE,2020-01-01,,1,8", "-3,+7,1e5,NA,NA,NA,x,null,2,9"]) + "\n")
    got = read_incidents(spark, str(path))
    assert dict(got.dtypes) == {"i": "int", "l": "bigint", "d": "double", "day": "date", "ts": "timestamp", "b": "boolean",
                                "mixed": "string", "none": "string", "big": "double", "a.b": "int"}
    assert [r.l for r in got.collect()] == [30000000000, 5, 7]
    texts = spark.createDataFrame([("2020-02-30", None), ("2020-02-01", None)], "bad_day string, n string")
    assert [tuple(r) for r in infer_types(texts).collect()] == [(1, "bad_day", "string", 2), (2, "n", "string", 0)]
    assert [r.data_type for r in infer_types(texts.limit(0)).collect()] == ["string", "string"]

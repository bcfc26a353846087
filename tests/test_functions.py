"""Scalar functions: text stripping, placeholders, numeric text (T4), dates."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.functions.dates import calendar, date_key, valid_date
from dimloom.functions.text import PLACEHOLDERS, is_bad_number, null_if_in, strip_lower, to_number


def test_strip_lower_and_placeholders(spark):
    rows = [(" Unknown ",), ("\tN/K\n",), ("unk",), ("",), ("<NA>",), ("Abc",), (None,)]
    df = spark.createDataFrame(rows, "v string")
    out = df.select(null_if_in(strip_lower(F.col("v")), PLACEHOLDERS + ("<na>",)).alias("v")).collect()
    assert [r.v for r in out] == [None, "n/k", None, None, None, "abc", None]


def test_numeric_text_pattern(spark):
    # Spark alone would accept '1d' and '1f'; the pattern rejects them, and 'inf'.
    values = ["12", " 12 ", "-1.5e3", ".5", "1.", "1d", "1f", "inf", "1_000", "several", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(to_number(F.col("v"), T.StringType()).alias("n"),
                    is_bad_number(F.col("v"), T.StringType()).alias("bad")).collect()
    assert [r.n for r in got] == [12.0, 12.0, -1500.0, 0.5, 1.0, None, None, None, None, None, None]
    assert [r.bad for r in got] == [False, False, False, False, False, True, True, True, True, True, False]


def test_valid_date_traps(spark):
    # concat_ws would turn (2000, NULL, 5) into '2000-5', a valid date (T1);
    # make_date raises on 30 February under ANSI.
    rows = [(2000, 2, 29), (1999, 2, 29), (2000, 2, 30), (1995, 0, 5), (1995, 3, 0),
            (1995, 4, 31), (2000, None, 5), (1850, 1, 1), (2150, 6, 1)]
    df = spark.createDataFrame(rows, "y int, m int, d int")
    got = df.select(valid_date(F.col("y"), F.col("m"), F.col("d")).alias("ok"),
                    date_key(F.col("y"), F.col("m"), F.col("d")).alias("k")).collect()
    assert [r.ok for r in got] == [True, False, False, False, False, False, False, True, True]
    # Real dates outside the calendar range get no key.
    assert [r.k for r in got] == [20000229, None, None, None, None, None, None, None, None]


def test_calendar_covers_range(spark):
    cal = calendar(spark)
    assert cal.count() == 73414
    first = cal.orderBy("DateKey").first()
    assert first.DateKey == 19000101 and first.FullDate == dt.date(1900, 1, 1)
    assert cal.agg(F.max("DateKey")).first()[0] == 21001231
    assert cal.select("DateKey").distinct().count() == 73414

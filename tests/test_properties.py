"""Property tests: each example is a whole list evaluated in one Spark job."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimloom.functions.dates import date_key, valid_date
from dimloom.operators.keys import assign_keys

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _py_date(y, m, d):
    try:
        return dt.date(y, m, d)
    except (ValueError, TypeError):
        return None


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 2999), st.integers(-1, 13), st.integers(-1, 32)), min_size=1, max_size=200))
def test_valid_date_matches_calendar(spark, parts):
    df = spark.createDataFrame(parts, "y int, m int, d int")
    got = df.select("y", "m", "d", valid_date(F.col("y"), F.col("m"), F.col("d")).alias("ok"),
                    date_key(F.col("y"), F.col("m"), F.col("d")).alias("k")).collect()
    for r in got:
        real = _py_date(r.y, r.m, r.d)
        assert r.ok == (real is not None and r.y >= 1753)
        in_range = real is not None and dt.date(1900, 1, 1) <= real <= dt.date(2100, 12, 31)
        assert r.k == (int(real.strftime("%Y%m%d")) if in_range else None)


@SETTINGS
@given(st.sets(st.tuples(st.integers(-50, 50), st.one_of(st.none(), st.text("abc", max_size=3))),
               min_size=1, max_size=300),
       st.integers(1, 120))
def test_dense_keys_equal_sorted_rank(spark, rows, bucket_rows):
    df = spark.createDataFrame(sorted(rows, key=repr), "a int, b string").repartition(3)
    keyed = assign_keys(df, ["a", "b"], "k", bucket_rows=bucket_rows)
    got = {(r.a, r.b): r.k for r in keyed.df.collect()}
    # Spark order: NULLs first, then byte order of text.
    expect = sorted(rows, key=lambda t: (t[0], t[1] is not None, (t[1] or "").encode()))
    assert got == {t: i + 1 for i, t in enumerate(expect)}

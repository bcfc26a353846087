"""Date predicates and keys built from integer year / month / day parts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Calendar range of the date dimension and its key check.
CALENDAR_START = _dt.date(1900, 1, 1)
CALENDAR_END = _dt.date(2100, 12, 31)
DATE_KEY_MIN = 19000101
DATE_KEY_MAX = 21001231
# Fixed value: the first year that the warehouse's date type holds.
FIRST_YEAR = 1753


def parts_date(year: Column, month: Column, day: Column) -> Column:
    """The calendar date of three integer parts, NULL when any part is NULL or
    the combination does not exist (day 0, month 0, 30 February ...) or lies before FIRST_YEAR.

    ``concat`` propagates NULL (unlike ``concat_ws``), and ``try_cast`` turns
    impossible dates into NULL instead of raising under ANSI mode.
    """
    y, m, d = (c.cast("int") for c in (year, month, day))
    text = F.concat(y.cast("string"), F.lit("-"), m.cast("string"), F.lit("-"), d.cast("string"))
    guarded = F.when(y.isNotNull() & m.isNotNull() & d.isNotNull() & (y >= FIRST_YEAR) & (y <= 9999), text)
    return guarded.try_cast("date")


def valid_date(year: Column, month: Column, day: Column) -> Column:
    """Predicate: the three parts form a real calendar date."""
    return parts_date(year, month, day).isNotNull()


def parts_in_range(year: Column, month: Column, day: Column) -> Column:
    """Range guard on each part (the observed-date dimension applies both)."""
    return (
        year.between(CALENDAR_START.year, CALENDAR_END.year)
        & month.between(1, 12)
        & day.between(1, 31)
    )


def date_key(year: Column, month: Column, day: Column) -> Column:
    """yyyymmdd integer for a valid date inside the calendar range, else NULL.

    Equivalent to a left join on the full calendar dimension, without the join.
    """
    d = parts_date(year, month, day)
    key = F.date_format(d, "yyyyMMdd").cast("int")
    return F.when(d.between(F.lit(CALENDAR_START), F.lit(CALENDAR_END)), key)


def date_key_of(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd").cast("int")


def calendar(spark: SparkSession, start: _dt.date = CALENDAR_START, end: _dt.date = CALENDAR_END,
             partitions: int | None = None) -> DataFrame:
    """Every day from ``start`` to ``end`` inclusive, one row per day.

    Generated per year with ``sequence``/``explode`` so the work is spread over
    partitions rather than produced one row at a time.
    """
    years = spark.range(start.year, end.year + 1, numPartitions=partitions or 8).select(
        F.col("id").cast("int").alias("y"))
    first = F.greatest(F.make_date(F.col("y"), F.lit(1), F.lit(1)), F.lit(start))
    last = F.least(F.make_date(F.col("y"), F.lit(12), F.lit(31)), F.lit(end))
    days = years.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("FullDate"))
    return days.select(
        date_key_of(F.col("FullDate")).alias("DateKey"),
        F.col("FullDate"),
        F.year("FullDate").alias("year"),
        F.month("FullDate").cast(T.ShortType()).alias("month"),
        F.dayofmonth("FullDate").cast(T.ShortType()).alias("day"),
    )

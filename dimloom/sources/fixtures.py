"""The ``raw_incidents`` fixture: a wide, messy event table derived from the
driver's TPC-H-like tables, one row per lineitem, so it grows with the scale
factor. It injects what cleaning must handle: placeholders, mixed case and
padding, NULL coordinates, impossible dates, bad numbers, repeated event ids,
one code with two labels, and a mostly-NULL column.

Join order is chosen for scale: orders meet customer on ``o_custkey``; the big
``lineitem`` is joined on ``l_partkey`` first, which adds little to its rows, then on
``l_orderkey``, so it is shuffled twice while narrow. The names of the tiny geography
(nation, region) come last, by broadcast, and are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimloom.sources.tables import read_table

# Column expressions of the fixture (same text as the DuckDB oracle's view).
RAW_COLUMNS = [
    "l_orderkey * 10 + l_linenumber AS eventid",
    "l_partkey AS tie1",
    "l_suppkey AS tie2",
    "l_extendedprice AS tie3",
    "CAST(year(l_shipdate) AS INT) AS iyear",
    "CASE WHEN l_partkey % 37 = 0 THEN 0 ELSE CAST(month(l_shipdate) AS INT) END AS imonth",
    "CASE WHEN l_partkey % 23 = 0 THEN 0 WHEN l_partkey % 29 = 0 THEN 31 "
    "ELSE CAST(day(l_shipdate) AS INT) END AS iday",
    "c_nationkey AS country",
    "CASE WHEN l_suppkey % 3 = 0 THEN n_name ELSE concat(' ', lower(n_name), ' ') END AS country_txt",
    "r_regionkey AS region",
    "CASE WHEN l_suppkey % 7 = 0 THEN lower(r_name) ELSE r_name END AS region_txt",
    "CASE WHEN c_custkey % 31 = 0 THEN 'Unknown' "
    "ELSE concat('Prov_', CAST(c_custkey % 50 AS STRING)) END AS provstate",
    "CASE WHEN c_custkey % 41 = 0 THEN ' unk ' "
    "ELSE concat('City_', CAST(c_custkey % 200 AS STRING)) END AS city",
    "CASE WHEN l_partkey % 43 = 0 THEN NULL ELSE CAST(c_custkey % 180 AS DOUBLE) - 90 END AS latitude",
    "CASE WHEN l_partkey % 47 = 0 THEN NULL ELSE CAST(c_custkey % 360 AS DOUBLE) - 180 END AS longitude",
    "CAST(substr(o_orderpriority, 1, 1) AS INT) AS attacktype1",
    "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Not Applicable' "
    "ELSE substr(o_orderpriority, 3) END AS attacktype1_txt",
    "p_size % 5 + 1 AS targtype1",
    "CASE WHEN p_size = 49 THEN 'Target other' "
    "ELSE concat('Target ', CAST(p_size % 5 + 1 AS STRING)) END AS targtype1_txt",
    "CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_size END AS targsubtype1",
    "CASE WHEN p_size % 9 = 0 THEN 'none' ELSE concat('Sub ', CAST(p_size AS STRING)) END AS targsubtype1_txt",
    "CAST(substr(p_brand, 7) AS INT) AS weaptype1",
    "p_brand AS weaptype1_txt",
    "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS weapsubtype1",
    "CASE WHEN l_linenumber = 7 THEN NULL "
    "ELSE concat(' Weapon sub ', CAST(l_linenumber AS STRING)) END AS weapsubtype1_txt",
    "CASE WHEN c_custkey % 5 = 0 THEN 'Unknown' "
    "ELSE concat(c_mktsegment, ' ', CAST(c_custkey % 30 AS STRING)) END AS gname",
    "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS success",
    "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 ELSE -9 END AS suicide",
    "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 ELSE -1 END AS multiple",
    "CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS extended",
    "CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0' ELSE '-9' END AS property",
    "CASE WHEN l_partkey % 19 = 0 THEN 'n/k' WHEN l_suppkey % 2 = 0 THEN '1' ELSE '0' END AS doubtterr",
    "CASE CAST(l_quantity AS INT) % 5 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '-9' "
    "WHEN 3 THEN '7' ELSE 'UNK' END AS ishostkid",
    "CASE WHEN l_partkey % 97 = 0 THEN 'several' WHEN l_partkey % 89 = 0 THEN '' "
    "ELSE CAST(CAST(l_quantity AS INT) % 13 AS STRING) END AS nkill",
    "CASE WHEN l_partkey % 83 = 0 THEN '1d' WHEN l_partkey % 79 = 0 THEN ' 12 ' "
    "ELSE CAST(CAST(l_quantity AS INT) % 7 AS STRING) END AS nwound",
    "CAST(CAST(l_quantity AS INT) % 2 AS STRING) AS nkillus",
    "CAST(CAST(l_quantity AS INT) % 3 AS STRING) AS nwoundus",
    "CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE CAST(l_linenumber % 2 AS STRING) END AS nkillter",
    "CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE '0' END AS nwoundte",
    "CASE WHEN l_orderkey % 10 = 0 THEN l_extendedprice END AS ransomamt",
    "concat('note ', CAST(l_orderkey AS STRING)) AS summary",
]


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide raw event table over the driver tables at ``sf_dir``."""
    t = lambda name: read_table(spark, sf_dir, name)
    # nation and region are tiny (25 and 5 rows at every scale factor); they are
    # still broadcast only through the same measured check as everything else.
    region = t("region")
    geo = t("nation").join(sized_side(region, region.count()), F.col("n_regionkey") == F.col("r_regionkey"))
    geo = geo.select("n_nationkey", "n_name", "r_regionkey", "r_name")
    # customer, orders, lineitem and part all grow with the data. customer and
    # part are broadcast only when their exact row count times the row width
    # of the pruned side fits the session's threshold; otherwise (and always
    # for orders x lineitem) a sort-merge join, which spills instead of failing.
    cust = t("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    orders = t("orders").join(sized_side(cust, cust.count()), F.col("o_custkey") == F.col("c_custkey"))
    part = t("part").select("p_partkey", "p_brand", "p_size")
    lines = t("lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))  # only its day is read
    lines = lines.join(sized_side(part, part.count()), F.col("l_partkey") == F.col("p_partkey"))
    lines = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    # nation and region have one row a key: the rows of nation bound that side
    lines = lines.join(sized_side(geo, t("nation").count()), F.col("c_nationkey") == F.col("n_nationkey"))
    return lines.selectExpr(*RAW_COLUMNS)


def sized_side(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint when ``max_rows`` (an upper bound on the rows of ``df``)
    times the row width fits the session threshold, else a merge-join hint."""
    from dimloom.operators.fact import fits_broadcast

    return F.broadcast(df) if fits_broadcast(df.sparkSession, max_rows, df.schema) else df.hint("merge")

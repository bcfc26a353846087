"""Registry entries for keys (K1, K2), incremental dimension loads (D1, J7),
sources and sinks (S1, S4, S6), the run log (E2, E3) and two roll-ups over the
finished star."""

from __future__ import annotations

import re
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.operators.dims import insert_new, keyed_dimension
from dimloom.operators.fact import fact_view, fits_broadcast
from dimloom.operators.keys import assign_keys
from dimloom.plans import oracle_base as O
from dimloom.plans.pipeline import WAREHOUSE_COLUMNS, raw, stage
from dimloom.plans.q_dims import star_ctes
from dimloom.plans.q_fact import _DIM_CTE, _EVENTS, fact_with
from dimloom.plans.registry import register
from dimloom.plans.specs import BY_NAME, DEDUPE_ORDER, DIMENSIONS, FACT_COLUMNS, LOOKUPS
from dimloom.plans.star import dimension, dimensions, saved_fact
from dimloom.plans.warehouse import FACT, Warehouse, load_dimension, log_view, reject_reason, run_warehouse
from dimloom.sources.contracts import FACT_RENAMES
from dimloom.session import new_scratch_path
from dimloom.sources.files import CSV_NULL_TOKENS, infer_types, read_incidents, write_clean
from dimloom.sources.tables import read_table

# ---- K1 / K2 / D1 --------------------------------------------------------

@register("key_dense", O.staged() + """
SELECT row_number() OVER (ORDER BY eventid) AS EventKey, eventid
FROM (SELECT DISTINCT eventid FROM stage)""")
def key_dense(spark, sf_dir):
    """K1: dense keys 1..n for the distinct event ids, in id order (range buckets,
    no single-partition window)."""
    events = stage(spark, sf_dir).select("eventid").distinct()
    return assign_keys(events, ["eventid"], "EventKey", key_type="long").df


# The incremental scenario: a first load saw the rows dated before 1998.
FIRST_LOAD_YEAR = 1998

_LOC = star_ctes("DimLocation", "allloc")
_FIRST = [c.replace("FROM stage WHERE", f"FROM stage WHERE year < {FIRST_LOAD_YEAR} AND").replace("allloc", "firstloc")
          for c in _LOC]
_INCREMENT = _FIRST + _LOC + ["""fresh AS (
SELECT a.country, a.region, a.City, a.Province, a.Latitude, a.Longitude FROM allloc a
WHERE NOT EXISTS (SELECT 1 FROM firstloc f WHERE f.country = a.country AND f.region = a.region AND f.City = a.City
  AND f.Province = a.Province AND f.Latitude = a.Latitude AND f.Longitude = a.Longitude))""", """appended AS (
SELECT CAST((SELECT coalesce(max(LocationKey), 0) FROM firstloc) + row_number() OVER (
  ORDER BY country NULLS FIRST, region NULLS FIRST, City NULLS FIRST, Province NULLS FIRST,
  Latitude NULLS FIRST, Longitude NULLS FIRST) AS INT) AS LocationKey, * FROM fresh)"""]


def _two_loads(spark, sf_dir):
    spec = BY_NAME["DimLocation"]
    s = stage(spark, sf_dir)
    first = keyed_dimension(s.where(F.col("year") < FIRST_LOAD_YEAR), spec)
    second = insert_new(s, spec, first.df)
    return first, second


@register("load_insert_new", O.staged(*_INCREMENT) + "SELECT * FROM appended")
def load_insert_new(spark, sf_dir):
    """D1 + J7: the location members a second load inserts (new natural keys only)."""
    return _two_loads(spark, sf_dir)[1].df


@register("key_incremental", O.staged(*_INCREMENT) + """
SELECT LocationKey, country, region, City, Province, Latitude, Longitude FROM firstloc
UNION ALL SELECT * FROM appended""")
def key_incremental(spark, sf_dir):
    """K2: the location dimension after both loads; new keys continue the old ones."""
    first, second = _two_loads(spark, sf_dir)
    return first.df.unionByName(second.df)


# ---- S1 / S6 / S4 --------------------------------------------------------

_TOKENS = "(" + ", ".join("'" + t.replace("'", "''") + "'" for t in CSV_NULL_TOKENS) + ")"


@register("src_csv_roundtrip", O.with_(O.RAW) + "SELECT " + ", ".join(
    f"CASE WHEN {c} IN {_TOKENS} THEN NULL ELSE {c} END AS {c}" if c in O.TEXT else c for c in O.RAW_ORDER)
    + " FROM raw")
def src_csv_roundtrip(spark, sf_dir):
    """S6 then S1: the raw table written as Latin-1 CSV and read back with its
    schema; text equal to a null token reads as NULL, as a dataframe CSV reader does."""
    df = raw(spark, sf_dir)
    path = new_scratch_path(spark, "csv")
    write_clean(df, path, "csv", encoding="ISO-8859-1", compression="snappy")
    return read_incidents(spark, path, schema=df.schema, encoding="ISO-8859-1")


_INT, _NUMBER = r"^[+-]?\d+$", r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def _type_sql(column: str) -> str:
    value = f"CASE WHEN CAST({column} AS VARCHAR) NOT IN {_TOKENS} THEN CAST({column} AS VARCHAR) END"
    whole = f"regexp_matches(v, '{_INT}')"
    return f"""SELECT '{column}' AS column_name, CASE WHEN count(v) = 0 THEN 'string'
  WHEN bool_and({whole} AND TRY_CAST(v AS INT) IS NOT NULL) FILTER (v IS NOT NULL) THEN 'int'
  WHEN bool_and({whole} AND TRY_CAST(v AS BIGINT) IS NOT NULL) FILTER (v IS NOT NULL) THEN 'bigint'
  WHEN bool_and(regexp_matches(v, '{_NUMBER}')) FILTER (v IS NOT NULL) THEN 'double' ELSE 'string' END AS data_type, count(v) AS non_null_rows
FROM (SELECT {value} AS v FROM raw)"""


@register("src_csv_inferred", O.with_(O.RAW) + " UNION ALL ".join(_type_sql(c) for c in O.RAW_ORDER))
def src_csv_inferred(spark, sf_dir):
    """The types of the raw table's columns as found in its CSV copy, with their values counted (one
    aggregation over all columns)."""
    path = new_scratch_path(spark, "csv")
    write_clean(raw(spark, sf_dir), path, "csv", encoding="ISO-8859-1", compression="snappy")
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in raw(spark, sf_dir).schema.fields])
    return infer_types(read_incidents(spark, path, schema=texts, encoding="ISO-8859-1")).drop("position")


# ---- E2 / E3 -------------------------------------------------------------

@register("log_view", """
SELECT event_id AS ETLLogID, strftime(ts, '%A, %B %-d, %Y') AS ETLDate, strftime(ts, '%H:%M') AS ETLTime,
  event_type AS ETLAction, props AS ETLLogMessage FROM events""")
def log_view_query(spark, sf_dir):
    """Log-view formatting over the events table (its time, action and message)."""
    ev = read_table(spark, sf_dir, "events")
    log = ev.select(F.col("event_id").alias("ETLLogID"), F.col("ts").alias("ETLDateAndTime"),
                    F.col("event_type").alias("ETLAction"), F.col("props").alias("ETLLogMessage"))
    return log_view(log)


def _status_sql() -> str:
    cte = {**_DIM_CTE, "DimRegion": "dreg"}
    steps = [("staging", "count(*) FROM stage"), ("reset", "0"), ("DimDate", "73414")]
    steps += [(spec.name, f"count(*) FROM {cte[spec.name]}") for spec in DIMENSIONS]
    steps += [("Fact_Terror_Events", "count(*) FROM fact WHERE DateKey IS NOT NULL")]
    steps += [("audit_references", "0"), ("audit_unique", "0"), ("audit_not_null", "0")]
    return fact_with(*star_ctes("DimRegion", "dreg")) + " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS INT) AS seq, '{name}' AS step, CAST(1 AS INT) AS status, CAST({rows.split(' FROM ')[0]} AS BIGINT) AS rows"
        + (" FROM " + rows.split(" FROM ", 1)[1] if " FROM " in rows else "") for i, (name, rows) in enumerate(steps))


@register("run_status", _status_sql())
def run_status(spark, sf_dir):
    """A full warehouse run into a fresh folder, with the key audits of what it
    published; one status row per step."""
    root = new_scratch_path(spark, "warehouse")
    return run_warehouse(spark, raw(spark, sf_dir), root, DIMENSIONS, LOOKUPS, FACT_COLUMNS, DEDUPE_ORDER,
                         protect=WAREHOUSE_COLUMNS).drop("message")


# Two runs: a first one over the events dated before 1998, then one over all of them, in which
# a foreign key is moved out of its dimension in some rows, so that it must publish nothing.
_PLANTED = "eventid % 10 = 3"


def _first(ctes: list[str], names: str) -> list[str]:
    """CTEs over the first load's rows, their names ending in 1."""
    return [re.sub(rf"\b(stage|{names})(_cand|_members)?\b", r"\g<1>1\g<2>", c) for c in ctes]


def _new_members(cte: str, natural) -> str:
    same = " AND ".join(f"f.{c} = a.{c}" for c in natural)
    return f"(SELECT count(*) FROM {cte} a WHERE NOT EXISTS (SELECT 1 FROM {cte}1 f WHERE {same}))"


def _rejected_run_sql() -> str:
    cte = {**_DIM_CTE, "DimRegion": "dreg"}
    ctes = [f"stage1 AS (SELECT * FROM stage WHERE year < {FIRST_LOAD_YEAR})"]
    for spec in DIMENSIONS:
        ctes += star_ctes(spec.name, cte[spec.name])
        ctes += _first(star_ctes(spec.name, cte[spec.name]), cte[spec.name])
    located = "EXISTS (SELECT 1 FROM dloc1 l WHERE l.country = e.country AND l.region = e.region AND l.City = e.city)"
    ctes += [*_EVENTS, *_first(_EVENTS, "ranked|dedup|ev|evk"),
             f"old AS (SELECT eventid FROM evk1 e WHERE DateKey IS NOT NULL AND {located})",
             f"fresh AS (SELECT eventid FROM evk e WHERE DateKey IS NOT NULL AND {located} AND eventid NOT IN (SELECT eventid FROM old))"]
    steps = [("staging", 1, "(SELECT count(*) FROM stage)"), ("DimDate", 0, "0")]
    for spec in DIMENSIONS:
        kept = spec.load_mode == "if_empty"
        steps.append((spec.name, 0 if kept else 1, "0" if kept else _new_members(cte[spec.name], spec.natural)))
    steps += [(FACT, -1, "0"), ("audit_references", -1, f"(SELECT count(*) FROM fresh WHERE {_PLANTED})"),
              ("audit_unique", 1, "0"), ("audit_not_null", 1, "0"), ("readable_fact", 1, "(SELECT count(*) FROM old)")]
    return O.staged(*ctes) + " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS INT) AS seq, '{name}' AS step, CAST({status} AS INT) AS status, CAST({rows} AS BIGINT) AS rows"
        for i, (name, status, rows) in enumerate(steps))


@register("run_status_rejected", _rejected_run_sql())
def run_status_rejected(spark, sf_dir):
    """E3 + Q5: statuses of a second run whose fact rows have orphan keys, and the rows of
    the fact that readers see after it (the first run's)."""
    root, rows = new_scratch_path(spark, "warehouse"), raw(spark, sf_dir)
    run_warehouse(spark, rows.where(F.col("iyear") < FIRST_LOAD_YEAR), root, DIMENSIONS, LOOKUPS, FACT_COLUMNS, DEDUPE_ORDER,
                  protect=WAREHOUSE_COLUMNS)
    planted = [F.when(F.expr(_PLANTED), F.lit(-7)).otherwise(F.col(c)).alias(c) if c == "CountryKey" else c for c in FACT_COLUMNS]
    second = run_warehouse(spark, rows, root, DIMENSIONS, LOOKUPS, planted, DEDUPE_ORDER, refresh=False,
                           protect=WAREHOUSE_COLUMNS).drop("message")
    seen = Warehouse(spark, root).table(FACT).agg(F.count(F.lit(1)).alias("rows"))
    steps = len(DIMENSIONS) + 7
    return second.unionByName(seen.select(F.lit(steps).alias("seq"), F.lit("readable_fact").alias("step"), F.lit(1).alias("status"), "rows"))


# Dimensions loaded twice in each mode: over the first load's rows, then over all.
_MODES = {"DimCountry": "dcty", "DimTargetSubType": "dtsub", "DimLocation": "dloc"}


def _modes_sql() -> str:
    ctes = [f"stage1 AS (SELECT * FROM stage WHERE year < {FIRST_LOAD_YEAR})"]
    for name, cte in _MODES.items():
        ctes += star_ctes(name, cte) + _first(star_ctes(name, cte), cte)
    out = []
    for name, cte in _MODES.items():
        one, two, new = f"(SELECT count(*) FROM {cte}1)", f"(SELECT count(*) FROM {cte})", _new_members(cte, BY_NAME[name].natural)
        for mode, status, rows, total in (("insert_new", 1, new, f"{one} + {new}"), ("if_empty", 0, "0", one), ("refresh", 1, two, two)):
            out.append((name, mode, 1, 1, one, one))
            out.append((name, mode, 2, status, rows, total))
    return O.staged(*ctes) + " UNION ALL ".join(
        f"SELECT '{n}' AS dimension, '{m}' AS mode, CAST({i} AS INT) AS load, CAST({s} AS INT) AS status, "
        f"CAST({r} AS BIGINT) AS rows, CAST({t} AS BIGINT) AS total_rows" for n, m, i, s, r, t in out)


@register("load_modes", _modes_sql())
def load_modes(spark, sf_dir):
    """D1-D3 + A7: two loads of a dimension in each mode (insert-new, if-empty, refresh): what
    each reports, and how many rows the table then has."""
    every, out = stage(spark, sf_dir), []
    for mode in ("insert_new", "if_empty", "refresh"):
        wh = Warehouse(spark, new_scratch_path(spark, "modes"))
        for name in _MODES:
            for i, rows in enumerate((every.where(F.col("year") < FIRST_LOAD_YEAR), every)):
                got = load_dimension(wh, rows, BY_NAME[name], mode)
                total = wh.table(name).agg(F.count(F.lit(1)).alias("total_rows"))
                head = [F.lit(v).alias(c) for c, v in (("dimension", name), ("mode", mode), ("load", i + 1), ("status", got.status))]
                out.append(total.select(*head, F.lit(got.rows).cast("long").alias("rows"), "total_rows"))
    return reduce(DataFrame.unionByName, out)


# Planted rows that a load must reject: no event id, one that is too long, no city, a year outside the calendar.
_BROKEN = """broken AS (SELECT * REPLACE (
  CASE WHEN tie1 % 97 = 0 THEN NULL WHEN tie1 % 89 = 0 THEN CAST(eventid AS VARCHAR) || repeat('9', 60)
       ELSE CAST(eventid AS VARCHAR) END AS eventid,
  CASE WHEN tie1 % 83 = 0 THEN NULL ELSE city END AS city, CASE WHEN tie1 % 79 = 0 THEN 1850 ELSE year END AS year) FROM stage)"""


@register("fact_rejects", fact_with(events=[_BROKEN, *[e.replace("FROM stage", "FROM broken") for e in _EVENTS]]) + """
SELECT reason, count(*) AS rows FROM (
  SELECT CASE WHEN e.eventid IS NULL THEN 'no event id' WHEN length(e.eventid) > 50 THEN 'event id over width'
    WHEN e.DateKey IS NULL THEN 'date outside the calendar' WHEN loc.LocationKey IS NULL THEN 'no location' END AS reason
  FROM evk e LEFT JOIN uloc loc ON loc.country = e.country AND loc.region = e.region AND loc.City = e.city)
WHERE reason IS NOT NULL GROUP BY reason""")
def fact_rejects(spark, sf_dir):
    """events that the load rejects, by reason (rows planted for each reason)."""
    tie, text = F.col("tie1"), F.col("eventid").cast("string")
    broken = stage(spark, sf_dir).withColumns({
        "eventid": F.when(tie % 97 == 0, None).when(tie % 89 == 0, F.concat(text, F.lit("9" * 60))).otherwise(text),
        "city": F.when(tie % 83 == 0, None).otherwise(F.col("city")),
        "year": F.when(tie % 79 == 0, 1850).otherwise(F.col("year")),
    })
    lookups = [replace(lk, how="left") for lk in LOOKUPS]
    view = fact_view(broken, dimensions(spark, sf_dir), lookups, FACT_COLUMNS, DEDUPE_ORDER, written=True)
    named = view.withColumnsRenamed(FACT_RENAMES).withColumn("reason", reject_reason())
    return named.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


# ---- roll-ups over the finished star ---------------------------------------

@register("star_by_year_country", fact_with() + """
SELECT CAST(DateKey / 10000 AS INT) AS year, CountryName, count(*) AS events,
  sum(num_killed) AS killed, sum(num_wounded) AS wounded
FROM fact GROUP BY CAST(DateKey / 10000 AS INT), CountryName""")
def star_by_year_country(spark, sf_dir):
    """Events, killed and wounded by year and country over the fact view."""
    f = saved_fact(spark, sf_dir)
    return (f.groupBy((F.col("DateKey") / 10000).cast("int").alias("year"), "CountryName")
            .agg(F.count(F.lit(1)).alias("events"), F.sum("num_killed").alias("killed"),
                 F.sum("num_wounded").alias("wounded")))


@register("star_by_category", fact_with() + """
SELECT a.AttackTypeLabel, t.TargetTypeLabel, count(*) AS events, sum(f.num_killed) AS killed
FROM fact f LEFT JOIN datk a ON a.AttackTypeKey = f.AttackTypeKey
LEFT JOIN dtgt t ON t.TargetTypeKey = f.TargetTypeKey
GROUP BY a.AttackTypeLabel, t.TargetTypeLabel""")
def star_by_category(spark, sf_dir):
    """Events and killed by attack type and target type labels (star join back to
    the dimensions by surrogate key)."""
    f = saved_fact(spark, sf_dir)
    out = f
    for name, key, label in (("DimAttackType", "AttackTypeKey", "AttackTypeLabel"),
                             ("DimTargetType", "TargetTypeKey", "TargetTypeLabel")):
        keyed = dimension(spark, sf_dir, name)
        side = keyed.df.select(key, label)
        side = F.broadcast(side) if fits_broadcast(spark, keyed.rows, side.schema, keyed.text_bytes) \
            else side.hint("merge")
        out = out.join(side, key, "left")
    return out.groupBy("AttackTypeLabel", "TargetTypeLabel").agg(
        F.count(F.lit(1)).alias("events"), F.sum("num_killed").alias("killed"))


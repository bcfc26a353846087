"""Registry entries for the audits (Q1-Q9, A3-A9) and the quarantine rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.functions.dates import DATE_KEY_MAX, DATE_KEY_MIN, valid_date
from dimloom.operators import audit as A
from dimloom.operators.clean import ALIGNMENT_PAIRS, GEO_COLUMNS, NUMERIC_COLUMNS, clean
from dimloom.plans import oracle_base as O
from dimloom.plans.pipeline import filled, profile, raw, stage
from dimloom.plans.q_dims import star_ctes
from dimloom.plans.q_fact import _DIM_CTE, fact_with
from dimloom.plans.registry import register
from dimloom.plans.specs import DEDUPE_ORDER, DIMENSIONS
from dimloom.plans.star import date_dimension, dimension, saved_fact
from dimloom.sources.contracts import FACT_RENAMES, FOREIGN_KEYS, SCHEMAS, conform, not_null_columns

_FILLED = [O.RAW, O.NORM, O.FILLED]
_BAD = "{c} IS NOT NULL AND NOT regexp_matches(trim({c}, " + O.WS + "), " + O.NUM + ")"


def _filled(spark, sf_dir) -> DataFrame:
    return filled(spark, sf_dir)


# ---- Q1 / A3 / A6 / A9 ---------------------------------------------------

_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS code_column, '{t}' AS label_column, CAST({c} AS VARCHAR) AS code, {t} AS label FROM filled"
    for c, t in ALIGNMENT_PAIRS)
_PAIRS = f"pairs AS ({_PAIRS_SQL})"


@register("audit_alignment", O.with_(*_FILLED, _PAIRS) + """
SELECT code_column, label_column, code, count(DISTINCT label) AS n_labels FROM pairs
WHERE code IS NOT NULL AND label IS NOT NULL GROUP BY code_column, label_column, code
HAVING count(DISTINCT label) > 1""")
def audit_alignment(spark, sf_dir):
    """Q1: codes with more than one label, over the seven code/label pairs."""
    return A.code_label_conflicts(_filled(spark, sf_dir), ALIGNMENT_PAIRS)


@register("audit_alignment_labels", O.with_(*_FILLED, _PAIRS) + """
SELECT DISTINCT p.code_column, p.label_column, p.code, p.label, c.n_labels FROM pairs p
JOIN (SELECT code_column, label_column, code, count(DISTINCT label) AS n_labels FROM pairs
      WHERE code IS NOT NULL AND label IS NOT NULL GROUP BY code_column, label_column, code
      HAVING count(DISTINCT label) > 1) c
  ON p.code_column = c.code_column AND p.label_column = c.label_column AND p.code = c.code
WHERE p.label IS NOT NULL""")
def audit_alignment_labels(spark, sf_dir):
    """The conflicting labels themselves, one row per (code, label)."""
    return A.code_label_conflicts(_filled(spark, sf_dir), ALIGNMENT_PAIRS, list_labels=True)


# ---- Q2 / A8 / S7 --------------------------------------------------------

def _bad_count(c: str) -> str:
    if c in O.NUMERIC_TEXT:
        return f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {_BAD.format(c=c)}) AS bad_rows FROM filled"
    return f"SELECT '{c}' AS column_name, CAST(0 AS BIGINT) AS bad_rows"  # numbers are never bad


@register("audit_non_numeric", O.with_(*_FILLED) + " UNION ALL ".join(_bad_count(c) for c in O.NUMERIC_PRESENT))
def audit_non_numeric(spark, sf_dir):
    """Q2: per numeric column, values present but not numeric (before coercion)."""
    return A.non_numeric(_filled(spark, sf_dir), NUMERIC_COLUMNS)


_BAD_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS bad_column, {c} AS bad_value, * FROM filled WHERE {_BAD.format(c=c)}" for c in O.NUMERIC_TEXT)


@register("quarantine_rows", O.with_(*_FILLED) + _BAD_ROWS)
def quarantine_rows(spark, sf_dir):
    """Full rows with a bad number, once per offending column."""
    return A.bad_rows(_filled(spark, sf_dir), NUMERIC_COLUMNS)


@register("audit_bad_values", O.with_(*_FILLED, f"bad AS ({_BAD_ROWS})") + """
SELECT column_name, bad_value, rank FROM (
  SELECT column_name, bad_value, CAST(row_number() OVER (PARTITION BY column_name ORDER BY bad_value) AS INT) AS rank
  FROM (SELECT DISTINCT bad_column AS column_name, bad_value FROM bad)) WHERE rank <= 10""")
def audit_bad_values(spark, sf_dir):
    """First ten distinct bad values of each numeric column, in text order."""
    return A.sample_bad_values(_filled(spark, sf_dir), NUMERIC_COLUMNS, 10)


# ---- Q3 / A4 -------------------------------------------------------------

@register("audit_row_counts", fact_with() + """
SELECT 'input_rows' AS step, count(*) AS row_count FROM raw
UNION ALL SELECT 'dropped_missing_required', count(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL) FROM raw
UNION ALL SELECT 'output_rows', count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL) FROM raw
UNION ALL SELECT 'distinct_events', count(*) FROM dedup
UNION ALL SELECT 'dated_events', count(*) FROM evk
UNION ALL SELECT 'fact_rows', count(*) FROM fact""")
def audit_row_counts(spark, sf_dir):
    """Q3: rows in, dropped for missing coordinates, out; then distinct events,
    events with a real date, and fact rows (after the inner location lookup)."""
    acct = A.row_accounting(clean(raw(spark, sf_dir), "text"), GEO_COLUMNS) \
        .select(F.col("stage").alias("step"), F.col("rows").alias("row_count"))
    s = stage(spark, sf_dir)
    from dimloom.operators.fact import dedupe

    is_dated = valid_date(F.col("year"), F.col("month"), F.col("day"))
    survivors = dedupe(s, ["eventid"], DEDUPE_ORDER).agg(
        F.count(F.lit(1)).alias("n"), F.sum(is_dated.cast("long")).alias("d"))
    counts = [
        survivors.selectExpr("stack(2, 'distinct_events', n, 'dated_events', coalesce(d, 0)) AS (step, row_count)"),
        saved_fact(spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit("fact_rows").alias("step"), "row_count"),
    ]
    return reduce(DataFrame.unionByName, [acct, *counts])


# ---- Q4 / A5 -------------------------------------------------------------

_RENAMED_COLS = [c.split(" AS ")[-1] for c in O.STAGE_COLUMNS] + ["ransomamt"]


@register("audit_null_profile", O.with_(O.RAW, O.NORM, O.FILLED, O.NUMBERS, O.RENAMED) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_rows, count(*) AS total_rows, "
    f"CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS null_share FROM renamed"
    for c in _RENAMED_COLS))
def audit_null_profile(spark, sf_dir):
    """Q4: NULL share of every column before the sparse drop, as counted while staging was written."""
    return profile(spark, sf_dir)


# ---- Q5 ------------------------------------------------------------------

_CALENDAR = ("cal AS (SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS DateKey FROM "
             "range(DATE '1900-01-01', DATE '2101-01-01', INTERVAL 1 DAY) t(d))")


def _ref_sql(col: str, dim: str) -> str:
    src = "cal" if dim == "DimDate" else _DIM_CTE[dim]
    return (f"SELECT '{col}' AS fk_column, '{dim}' AS dimension, count({col}) AS checked_rows, "
            f"count(*) - count({col}) AS null_rows, count(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN "
            f"(SELECT {col} FROM {src})) AS orphan_rows FROM fact")


@register("audit_references", fact_with(_CALENDAR) + " UNION ALL ".join(_ref_sql(c, d) for c, d, _ in FOREIGN_KEYS))
def audit_references(spark, sf_dir):
    """Q5: per foreign key of the fact, rows checked, NULL keys, orphan keys."""
    return A.reference_violations(saved_fact(spark, sf_dir), _references(spark, sf_dir))


# Planted orphans: each foreign key is moved out of its dimension in some rows.
_PLANT = [(col, 50 + i) for i, (col, _, _) in enumerate(FOREIGN_KEYS)]
_ORPHANS = "planted AS (SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN eventid % {n} = 0 THEN {c} + 1000000000 ELSE {c} END AS {c}" for c, n in _PLANT) + ") FROM fact)"


@register("audit_references_planted", fact_with(_CALENDAR, _ORPHANS) + " UNION ALL ".join(
    _ref_sql(c, d).replace("FROM fact", "FROM planted") for c, d, _ in FOREIGN_KEYS))
def audit_references_planted(spark, sf_dir):
    """Q5 over a fact in which every foreign key has orphans."""
    fact = saved_fact(spark, sf_dir)
    moved = {c: F.when(F.col("eventid") % n == 0, F.col(c) + 1000000000).otherwise(F.col(c)) for c, n in _PLANT}
    return A.reference_violations(fact.withColumns(moved), _references(spark, sf_dir))


def _references(spark, sf_dir):
    refs = []
    for col, dim, key in FOREIGN_KEYS:
        keyed = date_dimension(spark) if dim == "DimDate" else dimension(spark, sf_dir, dim)
        refs.append((col, dim, keyed.df, key, keyed.rows))
    return refs


# ---- Q6 / Q7 / Q8 / Q9 ---------------------------------------------------

@register("audit_unique", O.staged() + "SELECT eventid, count(*) AS n_rows FROM stage GROUP BY eventid HAVING count(*) > 1")
def audit_unique(spark, sf_dir):
    """Q6: event ids that occur more than once in staging."""
    return A.unique_violations(stage(spark, sf_dir), ["eventid"])


def _nn_sql() -> str:
    parts = []
    ctes = []
    for spec in DIMENSIONS:
        cte = _DIM_CTE.get(spec.name, "dreg")
        ctes += star_ctes(spec.name, cte)
        for col in not_null_columns(spec.name):
            if col in spec.out_names:
                parts.append(f"SELECT '{spec.name}' AS table_name, '{col}' AS column_name, "
                             f"count(*) - count({col}) AS null_rows FROM {cte}_cand")
    return O.staged(*ctes) + " UNION ALL ".join(parts)


@register("audit_not_null", _nn_sql())
def audit_not_null(spark, sf_dir):
    """Q7: NULLs in NOT NULL columns of every dimension's candidate rows (before
    members with a NULL code are left out), in one scan of staging."""
    return A.conditional_nulls(stage(spark, sf_dir), [
        (spec.name, out.name, spec.where() if spec.where else F.lit(True), out.column())
        for spec in DIMENSIONS for out in spec.columns if out.name in not_null_columns(spec.name)])


_RANGES = {"year": (1900, 2100), "month": (1, 12), "day": (1, 31)}


@register("audit_range", fact_with() + " UNION ALL ".join(
    [f"SELECT 'staging' AS table_name, '{c}' AS column_name, CAST({lo} AS BIGINT) AS lo, CAST({hi} AS BIGINT) AS hi, "
     f"count(*) FILTER (WHERE {c} NOT BETWEEN {lo} AND {hi}) AS bad_rows FROM stage" for c, (lo, hi) in _RANGES.items()]
    + [f"SELECT 'fact' AS table_name, 'DateKey' AS column_name, CAST({DATE_KEY_MIN} AS BIGINT) AS lo, "
       f"CAST({DATE_KEY_MAX} AS BIGINT) AS hi, count(*) FILTER (WHERE DateKey NOT BETWEEN {DATE_KEY_MIN} AND "
       f"{DATE_KEY_MAX}) AS bad_rows FROM fact"]))
def audit_range(spark, sf_dir):
    """Date parts of staging outside their ranges; fact date keys outside the CHECK range."""
    parts = A.range_violations(stage(spark, sf_dir), _RANGES).select(F.lit("staging").alias("table_name"), "*")
    keys = A.range_violations(saved_fact(spark, sf_dir), {"DateKey": (DATE_KEY_MIN, DATE_KEY_MAX)}) \
        .select(F.lit("fact").alias("table_name"), "*")
    return parts.unionByName(keys)


# Staging text column -> declared width of the warehouse column it feeds.
_FEEDS = {"country_txt": 100, "region_txt": 100, "attacktype1_txt": 100, "targtype1_txt": 100,
          "weaptype1_txt": 100, "weapsubtype1_txt": 100, "targsubtype1_txt": 100, "gname": 255,
          "city": 200, "provstate": 200}


# Planted long text, past the declared widths of the keys it feeds.
_LONG = {"city": (2, 250), "gname": (3, 300)}
_LENGTHENED = "longer AS (SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN tie1 % {m} = 0 THEN {c} || repeat('x', {n}) ELSE {c} END AS {c}" for c, (m, n) in _LONG.items()) \
    + ") FROM stage)"


@register("audit_width", O.staged(_LENGTHENED) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {w} AS width, CAST(max(length({c})) AS INT) AS max_length, "
    f"count(*) FILTER (WHERE length({c}) > {w}) AS over_width FROM longer" for c, w in _FEEDS.items()))
def audit_width(spark, sf_dir):
    """Q9: staging text longer than the warehouse column it feeds (with long cities
    and group names planted)."""
    longer = {c: F.when(F.col("tie1") % m == 0, F.concat(c, F.lit("x" * n))).otherwise(F.col(c)) for c, (m, n) in _LONG.items()}
    return A.width_violations(stage(spark, sf_dir).withColumns(longer), _FEEDS)


@register("audit_fact_contract", fact_with(
    "conformed AS (SELECT CAST(eventid AS VARCHAR) AS EventID, DateKey, LocationKey FROM fact)") + """
SELECT 'Fact_Terror_Events' AS table_name, 'EventID' AS column_name, count(*) - count(EventID) AS null_rows FROM conformed
UNION ALL SELECT 'Fact_Terror_Events', 'DateKey', count(*) - count(DateKey) FROM conformed
UNION ALL SELECT 'Fact_Terror_Events', 'LocationKey', count(*) - count(LocationKey) FROM conformed""")
def audit_fact_contract(spark, sf_dir):
    """Q7 on the fact: NULLs in the fact contract's NOT NULL columns."""
    fact = conform(saved_fact(spark, sf_dir).withColumnsRenamed(FACT_RENAMES), SCHEMAS["Fact_Terror_Events"])
    return A.null_violations({"Fact_Terror_Events": fact}, {"Fact_Terror_Events": not_null_columns("Fact_Terror_Events")})


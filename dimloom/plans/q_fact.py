"""Registry entries for de-duplication (W1), the date filter (P15), the key
lookups (J1-J6), the fact view (F1), contract shaping (P17) and the
incremental fact load (F2)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from dimloom.functions.dates import date_key, valid_date
from dimloom.operators.fact import dedupe, hot_for, lookup, measured, prepare_events, resolve_star
from dimloom.plans import oracle_base as O
from dimloom.plans.pipeline import stage
from dimloom.plans.q_dims import star_ctes
from dimloom.plans.registry import register
from dimloom.plans.specs import DEDUPE_ORDER, LOOKUP_BY_DIM, PRECISE_LOCATION
from dimloom.plans.star import dimension, saved_fact, star_fact
from dimloom.sources.contracts import FACT_RENAMES, SCHEMAS, conform
from dimloom.operators.fact import load_fact

# ---- oracle pieces -------------------------------------------------------

# CTE name of each dimension inside the fact oracle.
_DIM_CTE = {
    "DimLocation": "dloc", "DimCountry": "dcty", "DimAttackType": "datk", "DimTargetType": "dtgt",
    "DimTargetSubType": "dtsub", "DimWeaponType": "dwpn", "DimWeaponSubType": "dwsub",
    "DimPerpetratorGroup": "dgrp", "DimSuccess": "dsuc", "DimSuicide": "dsui",
    "DimPropertyDamage": "dprop", "DimHostageSituation": "dhost", "DimDoubtTerrorism": "ddbt",
    "DimEventType": "devt", "DimExtendedIncident": "dext", "DimAttackSuccessType": "dasx",
}

_DATE = ("CASE WHEN year >= 1753 THEN TRY_CAST(CAST(CAST(year AS INT) AS VARCHAR) || '-' || CAST(month AS INT) || '-' "
         "|| CAST(day AS INT) AS DATE) END")
_EVENTS = [
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY eventid ORDER BY tie1, tie2, tie3) AS rn FROM stage)",
    "dedup AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1)",
    f"ev AS (SELECT *, {_DATE} AS full_date FROM dedup WHERE ({_DATE}) IS NOT NULL)",
    "evk AS (SELECT *, CASE WHEN full_date BETWEEN DATE '1900-01-01' AND DATE '2100-12-31' "
    "THEN CAST(strftime(full_date, '%Y%m%d') AS INT) END AS DateKey FROM ev)",
]
_REDUCED = [
    "uloc AS (SELECT country, region, City, min(LocationKey) AS LocationKey FROM dloc GROUP BY country, region, City)",
    "ucty AS (SELECT GTDCountryCode, min(CountryKey) AS CountryKey, arg_min(CountryName, CountryKey) AS CountryName "
    "FROM dcty GROUP BY GTDCountryCode)",
    "uatk AS (SELECT attacktype1, min(AttackTypeKey) AS AttackTypeKey FROM datk GROUP BY attacktype1)",
    "utgt AS (SELECT targtype1, min(TargetTypeKey) AS TargetTypeKey FROM dtgt GROUP BY targtype1)",
    "utsub AS (SELECT targsubtype1, min(TargetSubTypeKey) AS TargetSubTypeKey FROM dtsub GROUP BY targsubtype1)",
    "uwpn AS (SELECT weaptype1, min(WeaponTypeKey) AS WeaponTypeKey FROM dwpn GROUP BY weaptype1)",
    "uwsub AS (SELECT weapsubtype1, min(WeaponSubTypeKey) AS WeaponSubTypeKey FROM dwsub GROUP BY weapsubtype1)",
    "ugrp AS (SELECT GroupName, min(PerpetratorGroupKey) AS PerpetratorGroupKey FROM dgrp GROUP BY GroupName)",
    "usuc AS (SELECT IsSuccessful, min(SuccessKey) AS SuccessKey FROM dsuc GROUP BY IsSuccessful)",
    "usui AS (SELECT IsSuicide, min(SuicideKey) AS SuicideKey FROM dsui GROUP BY IsSuicide)",
    "uprop AS (SELECT PropertyDamageCode, min(PropertyDamageKey) AS PropertyDamageKey FROM dprop "
    "GROUP BY PropertyDamageCode)",
    "uhost AS (SELECT HostageSituationCode, min(HostageSituationKey) AS HostageSituationKey FROM dhost "
    "GROUP BY HostageSituationCode)",
    "udbt AS (SELECT DoubtTerrorismCode, min(DoubtTerrorismKey) AS DoubtTerrorismKey FROM ddbt "
    "GROUP BY DoubtTerrorismCode)",
    "uevt AS (SELECT IsMultiple, min(EventTypeKey) AS EventTypeKey FROM devt GROUP BY IsMultiple)",
    "uext AS (SELECT IsExtended, min(ExtendedIncidentKey) AS ExtendedIncidentKey FROM dext GROUP BY IsExtended)",
    "uasx AS (SELECT SuccessCode, min(AttackSuccessTypeKey) AS AttackSuccessTypeKey FROM dasx GROUP BY SuccessCode)",
]
# The fact's columns and what each lookup matches.
_FACT = """fact AS (
SELECT e.eventid, e.DateKey, loc.LocationKey, c.CountryKey, c.CountryName, e.country AS GTDCountryCode,
  atk.AttackTypeKey, tgt.TargetTypeKey, tsub.TargetSubTypeKey, wpn.WeaponTypeKey, wsub.WeaponSubTypeKey,
  grp.PerpetratorGroupKey, suc.SuccessKey, sui.SuicideKey, prop.PropertyDamageKey, host.HostageSituationKey,
  dbt.DoubtTerrorismKey, evt.EventTypeKey, ext.ExtendedIncidentKey, asx.AttackSuccessTypeKey,
  e.num_killed, e.num_wounded, e.num_us_killed, e.num_us_wounded, e.num_terrorists_killed,
  e.num_terrorists_wounded
FROM evk e
JOIN uloc loc ON loc.country = e.country AND loc.region = e.region AND loc.City = e.city
LEFT JOIN ucty c ON c.GTDCountryCode = e.country
LEFT JOIN uatk atk ON atk.attacktype1 = e.attacktype1
LEFT JOIN utgt tgt ON tgt.targtype1 = e.targtype1
LEFT JOIN utsub tsub ON tsub.targsubtype1 = coalesce(e.targsubtype1, 0)
LEFT JOIN uwpn wpn ON wpn.weaptype1 = e.weaptype1
LEFT JOIN uwsub wsub ON wsub.weapsubtype1 = coalesce(e.weapsubtype1, 0)
LEFT JOIN ugrp grp ON grp.GroupName = coalesce(e.gname, 'Perp Group Not Given')
LEFT JOIN usuc suc ON suc.IsSuccessful = e.success
LEFT JOIN usui sui ON sui.IsSuicide = e.suicide
LEFT JOIN uprop prop ON prop.PropertyDamageCode = e.property
LEFT JOIN uhost host ON host.HostageSituationCode = coalesce(e.ishostkid, 2)
LEFT JOIN udbt dbt ON dbt.DoubtTerrorismCode = e.doubtterr
LEFT JOIN uevt evt ON evt.IsMultiple = e.multiple
LEFT JOIN uext ext ON ext.IsExtended = e.extended
LEFT JOIN uasx asx ON asx.SuccessCode = e.success
)"""


def _dims_ctes() -> list[str]:
    out = []
    for name, cte in _DIM_CTE.items():
        out += star_ctes(name, cte)
    return out


def fact_with(*more: str, events=None) -> str:
    """WITH clause holding staging, the 16 looked-up dimensions, events, the fact."""
    return O.staged(*_dims_ctes(), *(events or _EVENTS), *_REDUCED, _FACT, *more)


_EVENTS_FILTER_FIRST = [
    f"valid AS (SELECT *, {_DATE} AS full_date FROM stage WHERE ({_DATE}) IS NOT NULL)",
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY eventid ORDER BY tie1, tie2, tie3) AS rn FROM valid)",
    "ev AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1)",
    _EVENTS[3],
]

_CONFORMED = """conformed AS (
SELECT CAST(eventid AS VARCHAR) AS EventID, DateKey, LocationKey, CountryKey, AttackTypeKey, TargetTypeKey,
  TargetSubTypeKey, WeaponTypeKey, WeaponSubTypeKey, PerpetratorGroupKey, SuccessKey, SuicideKey,
  PropertyDamageKey, HostageSituationKey, DoubtTerrorismKey, CAST(NULL AS INT) AS AlternativeDesignationKey,
  EventTypeKey, ExtendedIncidentKey, AttackSuccessTypeKey,
  TRY_CAST(trunc(num_killed) AS INT) AS NumKilled, TRY_CAST(trunc(num_wounded) AS INT) AS NumWounded,
  TRY_CAST(trunc(num_us_killed) AS INT) AS NumUSKilled, TRY_CAST(trunc(num_us_wounded) AS INT) AS NumUSWounded,
  TRY_CAST(trunc(num_terrorists_killed) AS INT) AS NumTerroristsKilled,
  TRY_CAST(trunc(num_terrorists_wounded) AS INT) AS NumTerroristsWounded
FROM fact)"""

# The incremental scenario: a first load took the events dated before 1998.
FIRST_LOAD_BEFORE = 19980101


def _events(spark, sf_dir):
    return prepare_events(stage(spark, sf_dir), DEDUPE_ORDER, written=True)


def _lookup(events, spark, sf_dir, dim_name):
    spec = LOOKUP_BY_DIM[dim_name]
    keyed = measured(spark, dimension(spark, sf_dir, dim_name), spec)
    return lookup(events, keyed.df, spec, keyed.rows, keyed.text_bytes,
                  hot_for(stage(spark, sf_dir), keyed, spec), unique_on=keyed.unique_on, salt_on=("eventid",))


# ---- queries -------------------------------------------------------------

@register("dedupe_events", O.staged(*_EVENTS[:2]) + "SELECT * FROM dedup")
def dedupe_events(spark, sf_dir):
    """One row per event id; the survivor is the first by (tie1, tie2, tie3)."""
    return dedupe(stage(spark, sf_dir), ["eventid"], DEDUPE_ORDER, written=True)


# Every seventh row gets a year before the first one that counts as a date.
_EARLY = "early AS (SELECT * REPLACE (CASE WHEN tie1 % 7 = 0 THEN 1700 + tie1 % 100 ELSE year END AS year) FROM stage)"


@register("filter_valid_date", O.staged(_EARLY) + f"""
SELECT eventid, tie1, tie2, tie3, CAST(year AS INT) AS year, month, day,
  CASE WHEN ({_DATE}) BETWEEN DATE '1900-01-01' AND DATE '2100-12-31'
       THEN CAST(strftime(({_DATE}), '%Y%m%d') AS INT) END AS DateKey
FROM early WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL AND ({_DATE}) IS NOT NULL""")
def filter_valid_date(spark, sf_dir):
    """P15 + J4: staging rows whose parts form a real date, with the date key
    (with years before 1753 planted, which don't count as dates)."""
    early = F.when(F.col("tie1") % 7 == 0, 1700 + F.col("tie1") % 100).otherwise(F.col("year")).cast("int")
    y, m, d = F.col("year"), F.col("month"), F.col("day")
    return (stage(spark, sf_dir).withColumn("year", early).where(valid_date(y, m, d))
            .select("eventid", "tie1", "tie2", "tie3", "year", "month", "day",
                    date_key(y, m, d).alias("DateKey")))


@register("fact_lookup_date", fact_with() + "SELECT eventid, DateKey FROM evk")
def fact_lookup_date(spark, sf_dir):
    """The date key of each de-duplicated, dated event (computed, no join)."""
    return _events(spark, sf_dir).select("eventid", "DateKey")


@register("fact_lookup_country", fact_with() + """
SELECT e.eventid, e.country, c.CountryKey, c.CountryName FROM evk e LEFT JOIN ucty c ON c.GTDCountryCode = e.country""")
def fact_lookup_country(spark, sf_dir):
    """Plain left lookup of the country key (and name) by code."""
    return _lookup(_events(spark, sf_dir), spark, sf_dir, "DimCountry").select(
        "eventid", "country", "CountryKey", "CountryName")


@register("fact_lookup_defaulted", fact_with() + """
SELECT e.eventid, tsub.TargetSubTypeKey, wsub.WeaponSubTypeKey, grp.PerpetratorGroupKey, host.HostageSituationKey
FROM evk e
LEFT JOIN utsub tsub ON tsub.targsubtype1 = coalesce(e.targsubtype1, 0)
LEFT JOIN uwsub wsub ON wsub.weapsubtype1 = coalesce(e.weapsubtype1, 0)
LEFT JOIN ugrp grp ON grp.GroupName = coalesce(e.gname, 'Perp Group Not Given')
LEFT JOIN uhost host ON host.HostageSituationCode = coalesce(e.ishostkid, 2)""")
def fact_lookup_defaulted(spark, sf_dir):
    """Lookups whose fact code is defaulted first (subtypes 0, group name, hostage 2)."""
    ev = _events(spark, sf_dir)
    for dim in ("DimTargetSubType", "DimWeaponSubType", "DimPerpetratorGroup", "DimHostageSituation"):
        ev = _lookup(ev, spark, sf_dir, dim)
    return ev.select("eventid", "TargetSubTypeKey", "WeaponSubTypeKey", "PerpetratorGroupKey", "HostageSituationKey")


@register("fact_lookup_location", fact_with() + """
SELECT e.eventid, loc.LocationKey FROM evk e
JOIN uloc loc ON loc.country = e.country AND loc.region = e.region AND loc.City = e.city""")
def fact_lookup_location(spark, sf_dir):
    """Inner composite lookup on (country, region, city); unmatched events drop."""
    return _lookup(_events(spark, sf_dir), spark, sf_dir, "DimLocation").select("eventid", "LocationKey")


@register("fact_lookup_location_precise", fact_with() + """
SELECT e.eventid, min(d.LocationKey) AS LocationKey FROM evk e
JOIN dloc d ON d.country IS NOT DISTINCT FROM e.country AND d.region IS NOT DISTINCT FROM e.region
  AND d.City IS NOT DISTINCT FROM e.city AND d.Province IS NOT DISTINCT FROM e.provstate
  AND d.Latitude IS NOT DISTINCT FROM e.latitude AND d.Longitude IS NOT DISTINCT FROM e.longitude
GROUP BY e.eventid""")
def fact_lookup_location_precise(spark, sf_dir):
    """J3 (precise, T8): the location matched on all six columns, NULL-safely."""
    keyed = dimension(spark, sf_dir, "DimLocation")
    return lookup(_events(spark, sf_dir), keyed.df, PRECISE_LOCATION, keyed.rows, keyed.text_bytes,
                  hot_for(stage(spark, sf_dir), keyed, PRECISE_LOCATION), unique_on=keyed.unique_on, salt_on=("eventid",)).select(
        "eventid", "LocationKey")


# Variants of a name that differ in case and trailing spaces only.
_VARIANT = ("CASE WHEN tie1 % 3 = 0 THEN upper({0}) || '  ' WHEN tie1 % 5 = 0 THEN upper(substr({0}, 1, 1)) || substr({0}, 2) "
            "WHEN tie1 % 7 = 0 THEN {0} || ' ' ELSE {0} END")


@register("fact_lookup_collated", fact_with(
    f"ragged AS (SELECT * REPLACE ({_VARIANT.format('city')} AS city, {_VARIANT.format('gname')} AS gname) FROM evk)") + """
SELECT e.eventid, e.city, e.gname, loc.LocationKey, grp.PerpetratorGroupKey FROM ragged e
LEFT JOIN (SELECT country, region, lower(rtrim(City)) AS City, min(LocationKey) AS LocationKey FROM dloc GROUP BY ALL) loc
  ON loc.country = e.country AND loc.region = e.region AND loc.City = lower(rtrim(e.city))
LEFT JOIN (SELECT lower(rtrim(GroupName)) AS GroupName, min(PerpetratorGroupKey) AS PerpetratorGroupKey FROM dgrp GROUP BY ALL) grp
  ON grp.GroupName = lower(rtrim(coalesce(e.gname, 'Perp Group Not Given')))""")
def fact_lookup_collated(spark, sf_dir):
    """J3 + J2 (T9): location and group looked up by texts that match whatever their case and
    trailing spaces (variants planted in the events)."""
    ragged = _events(spark, sf_dir).withColumns({c: F.expr(_VARIANT.format(c)) for c in ("city", "gname")})
    lookups = [replace(LOOKUP_BY_DIM["DimLocation"], how="left", collated=(2,)), replace(LOOKUP_BY_DIM["DimPerpetratorGroup"], collated=(0,))]
    dims = {s.dim: dimension(spark, sf_dir, s.dim) for s in lookups}
    found = resolve_star(ragged, dims, lookups, hot_source=stage(spark, sf_dir), salt_on=("eventid",))
    return found.select("eventid", "city", "gname", "LocationKey", "PerpetratorGroupKey")


@register("fact_lookup_event_type", fact_with() + """
SELECT e.eventid, e.multiple, evt.EventTypeKey FROM evk e LEFT JOIN uevt evt ON evt.IsMultiple = e.multiple""")
def fact_lookup_event_type(spark, sf_dir):
    """Lookup through the smallest key per code."""
    return _lookup(_events(spark, sf_dir), spark, sf_dir, "DimEventType").select("eventid", "multiple", "EventTypeKey")


@register("fact_view", fact_with() + "SELECT * FROM fact")
def fact_view_query(spark, sf_dir):
    """F1 (flagship): de-duplicated, dated events resolved to all 17 keys."""
    return star_fact(spark, sf_dir)


@register("fact_view_filter_first", fact_with(events=_EVENTS_FILTER_FIRST) + "SELECT * FROM fact")
def fact_view_filter_first(spark, sf_dir):
    """F1 with the invalid-date filter applied before picking each event's survivor."""
    return star_fact(spark, sf_dir, dedupe_first=False)


@register("contract_conform", fact_with(_CONFORMED) + "SELECT * FROM conformed")
def contract_conform(spark, sf_dir):
    """The fact view shaped to the fact table contract."""
    return conform(saved_fact(spark, sf_dir).withColumnsRenamed(FACT_RENAMES), SCHEMAS["Fact_Terror_Events"])


@register("fact_load_incremental", fact_with(_CONFORMED) + f"""
SELECT * FROM conformed WHERE NOT coalesce(DateKey < {FIRST_LOAD_BEFORE}, FALSE)""")
def fact_load_incremental(spark, sf_dir):
    """F2 + J8: after a first load of the events dated before 1998, a full load
    appends only the events not yet present."""
    view = saved_fact(spark, sf_dir)
    contract = SCHEMAS["Fact_Terror_Events"]
    empty = spark.createDataFrame([], contract)
    first = load_fact(view.where(F.col("DateKey") < FIRST_LOAD_BEFORE), empty, contract, FACT_RENAMES)
    return load_fact(view, first, contract, FACT_RENAMES)


@register("dim_date_in_use", fact_with(
    "cal AS (SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS DateKey, CAST(d AS DATE) AS FullDate, "
    "CAST(year(d) AS INT) AS year, CAST(month(d) AS SMALLINT) AS month, CAST(day(d) AS SMALLINT) AS day "
    "FROM range(DATE '1900-01-01', DATE '2101-01-01', INTERVAL 1 DAY) t(d))") + """
SELECT * FROM cal WHERE EXISTS (SELECT 1 FROM fact f WHERE f.DateKey = cal.DateKey)""")
def dim_date_in_use(spark, sf_dir):
    """D-Date + J9: calendar days (1900-2100, generated) that fact rows refer to."""
    from dimloom.operators.dims import members_in_use
    from dimloom.plans.star import date_dimension

    return members_in_use(date_dimension(spark).df, saved_fact(spark, sf_dir), [("DateKey", "DateKey")])

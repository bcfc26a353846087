"""Registry entries for the dimensions (D0 + K1 for each of the 17 specs),
the observed-date view, membership joins (J9, J10) and key reduction (A2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimloom.functions.dates import parts_date, parts_in_range
from dimloom.operators.dims import keyed_dimension, members_in_use
from dimloom.operators.keys import unique_keys
from dimloom.plans import oracle_base as O
from dimloom.plans.pipeline import stage
from dimloom.plans.registry import register
from dimloom.plans.specs import BY_NAME, GROUP_DEFAULT, bit_compat
from dimloom.plans.star import dimension


def dim_ctes(cte: str, key: str, cols: list[tuple[str, str]], where: str | None = None,
             natural: int = 1, policy: str = "min_label", not_null: bool = True) -> list[str]:
    """Oracle CTEs for a keyed dimension named ``cte``: candidate rows, one member
    per natural key (smallest other values) or all distinct rows, keys in
    column order."""
    names = [n for n, _ in cols]
    nat, rest = names[:natural], names[natural:]
    cand = f"SELECT {', '.join(f'{e} AS {n}' for n, e in cols)} FROM stage" + (f" WHERE {where}" if where else "")
    nn = " AND ".join(f"{n} IS NOT NULL" for n in nat) if not_null else "TRUE"
    if policy == "min_label" and rest:
        members = (f"SELECT {', '.join(nat)}, {', '.join(f'min({r}) AS {r}' for r in rest)} "
                   f"FROM {cte}_cand WHERE {nn} GROUP BY {', '.join(nat)}")
    else:
        members = f"SELECT DISTINCT * FROM {cte}_cand WHERE {nn}"
    order = ", ".join(f"{n} NULLS FIRST" for n in names)
    keyed = f"SELECT CAST(row_number() OVER (ORDER BY {order}) AS INT) AS {key}, {', '.join(names)} FROM {cte}_members"
    return [f"{cte}_cand AS ({cand})", f"{cte}_members AS ({members})", f"{cte} AS ({keyed})"]


def dim_sql(*args, **kw) -> str:
    return O.staged(*dim_ctes("d", *args, **kw)) + "SELECT * FROM d"


def _def(*a, **k):
    return (a, k)


def _case(src: str, labels, null_label=None, else_label=None) -> str:
    parts = []
    if null_label is not None:
        parts.append(f"WHEN {src} IS NULL THEN '{null_label}'")
    parts += [f"WHEN {src} = {v} THEN '{t}'" for v, t in labels]
    tail = f" ELSE '{else_label}'" if else_label is not None else ""
    return f"CASE {' '.join(parts)}{tail} END"


def _lbl(src: str, width: int = 100) -> str:
    return f"substr(CAST({src} AS VARCHAR), 1, {width})"


# Columns, codes and labels of the dimensions.
DIM_DEFS = {
    "DimCountry": _def("CountryKey", [("GTDCountryCode", "CAST(country AS INT)"),
                                         ("CountryName", _lbl("country_txt"))],
                          "country IS NOT NULL AND country_txt IS NOT NULL"),
    "DimRegion": _def("RegionKey", [("region", "CAST(region AS INT)"), ("RegionName", _lbl("region_txt"))],
                         "region IS NOT NULL AND region_txt IS NOT NULL"),
    "DimAttackType": _def("AttackTypeKey", [
        ("attacktype1", "CAST(attacktype1 AS INT)"),
        ("AttackTypeLabel", _lbl("coalesce(attacktype1_txt, 'Attack Type Not Given')"))],
        "attacktype1 IS NOT NULL"),
    "DimTargetType": _def("TargetTypeKey", [
        ("targtype1", "CAST(targtype1 AS INT)"),
        ("TargetTypeLabel", _lbl("coalesce(targtype1_txt, 'Target Type Not Given')"))],
        "targtype1 IS NOT NULL"),
    "DimWeaponType": _def("WeaponTypeKey", [
        ("weaptype1", "CAST(weaptype1 AS INT)"),
        ("WeaponTypeLabel", _lbl("coalesce(weaptype1_txt, 'Weapon Type Not Given')"))],
        "weaptype1 IS NOT NULL"),
    "DimPerpetratorGroup": _def("PerpetratorGroupKey", [
        ("GroupName", "coalesce(gname, 'Perp Group Not Given')")]),
    "DimSuccess": _def("SuccessKey", [
        ("IsSuccessful", "CAST(success AS SMALLINT)"),
        ("Description", _case("success", [(1, "Successful"), (0, "Unsuccessful")]))]),
    "DimSuicide": _def("SuicideKey", [
        ("IsSuicide", "CAST(suicide AS SMALLINT)"),
        ("Description", _case("suicide", [(1, "Suicide Attack"), (0, "Not a Suicide Attack")],
                              else_label="Unknown"))], "suicide IN (0, 1)"),
    "DimPropertyDamage": _def("PropertyDamageKey", [
        ("PropertyDamageCode", "CAST(property AS SMALLINT)"),
        ("Description", _case("property", [(1, "Property Damaged"), (0, "No Property Damage"),
                                           (-9, "No Data")]))]),
    "DimHostageSituation": _def("HostageSituationKey", [
        ("HostageSituationCode", "CAST(coalesce(ishostkid, 2) AS SMALLINT)"),
        ("Description", _case("ishostkid", [(1, "Hostage Situation"), (0, "No Hostage Situation"),
                                            (-9, "Unknown")], "No Data Given", "Invalid Code"))]),
    "DimDoubtTerrorism": _def("DoubtTerrorismKey", [
        ("DoubtTerrorismCode", "CAST(doubtterr AS SMALLINT)"),
        ("Description", _case("doubtterr", [(1, "Doubt Terrorism"), (0, "No Doubt"), (-9, "Unknown")]))]),
    "DimEventType": _def("EventTypeKey", [
        ("IsMultiple", "CAST(multiple AS SMALLINT)"),
        ("Description", _case("multiple", [(1, "Multiple Incident"), (0, "Single Incident"), (-1, "Unknown")]))]),
    "DimExtendedIncident": _def("ExtendedIncidentKey", [
        ("IsExtended", "CAST(extended AS SMALLINT)"),
        ("Description", _case("extended", [(1, "Extended Incident"), (0, "Not Extended")]))]),
    "DimWeaponSubType": _def("WeaponSubTypeKey", [
        ("weapsubtype1", "CAST(coalesce(weapsubtype1, 0) AS INT)"),
        ("WeaponSubTypeLabel", _lbl("coalesce(weapsubtype1_txt, 'No Data for Weapon Subtype')"))]),
    "DimTargetSubType": _def("TargetSubTypeKey", [
        ("targsubtype1", "CAST(coalesce(targsubtype1, 0) AS INT)"),
        ("TargetSubTypeLabel", _lbl("coalesce(targsubtype1_txt, 'No Data for Target Subtype')"))]),
    "DimAttackSuccessType": _def("AttackSuccessTypeKey", [
        ("SuccessCode", "CAST(success AS INT)"),
        ("SuccessLabel", _case("success", [(1, "Attack Successful"), (0, "Attack Failed")],
                               else_label="Unknown"))], "success IN (0, 1)"),
    "DimLocation": _def("LocationKey", [
        ("country", "CAST(country AS INT)"), ("region", "CAST(region AS INT)"),
        ("City", "CAST(city AS VARCHAR)"), ("Province", "CAST(provstate AS VARCHAR)"),
        ("Latitude", "CAST(latitude AS DOUBLE)"), ("Longitude", "CAST(longitude AS DOUBLE)")],
        "country IS NOT NULL AND region IS NOT NULL AND city IS NOT NULL", natural=6,
        policy="keep_all", not_null=False),
}

DIM_ORACLES = {name: O.staged(*dim_ctes("d", *a, **k)) + "SELECT * FROM d" for name, (a, k) in DIM_DEFS.items()}


def star_ctes(name: str, cte: str) -> list[str]:
    a, k = DIM_DEFS[name]
    return dim_ctes(cte, *a, **k)


QUERY_NAMES = {
    "DimCountry": "dim_country", "DimRegion": "dim_region", "DimAttackType": "dim_attack_type",
    "DimTargetType": "dim_target_type", "DimWeaponType": "dim_weapon_type",
    "DimPerpetratorGroup": "dim_group", "DimSuccess": "dim_success", "DimSuicide": "dim_suicide",
    "DimPropertyDamage": "dim_property_damage", "DimHostageSituation": "dim_hostage",
    "DimDoubtTerrorism": "dim_doubt", "DimEventType": "dim_event_type",
    "DimExtendedIncident": "dim_extended", "DimWeaponSubType": "dim_weapon_subtype",
    "DimTargetSubType": "dim_target_subtype", "DimAttackSuccessType": "dim_attack_success",
    "DimLocation": "dim_location",
}


def _dim_query(dim_name: str):
    def run(spark, sf_dir):
        return dimension(spark, sf_dir, dim_name).df

    run.__name__ = QUERY_NAMES[dim_name]
    run.__doc__ = f"D0 + K1: the keyed {dim_name} dimension."
    return run


for _name, _query in QUERY_NAMES.items():
    register(_query, DIM_ORACLES[_name])(_dim_query(_name))


@register("dim_target_type_keep_all", dim_sql("TargetTypeKey", [
    ("targtype1", "CAST(targtype1 AS INT)"),
    ("TargetTypeLabel", _lbl("coalesce(targtype1_txt, 'Target Type Not Given')"))],
    "targtype1 IS NOT NULL", policy="keep_all"))
def dim_target_type_keep_all(spark, sf_dir):
    """T5: every distinct (code, label) pair, as a plain DISTINCT load would keep."""
    from dataclasses import replace

    spec = replace(BY_NAME["DimTargetType"], on_conflict="keep_all")
    return keyed_dimension(stage(spark, sf_dir), spec).df


@register("dim_event_type_bit", dim_sql("EventTypeKey", [
    ("IsMultiple", "CAST(CASE WHEN multiple <> 0 THEN 1 WHEN multiple = 0 THEN 0 END AS SMALLINT)"),
    ("Description", _case("multiple", [(1, "Multiple Incident"), (0, "Single Incident"), (-1, "Unknown")]))],
    policy="keep_all"))
def dim_event_type_bit(spark, sf_dir):
    """The event-type dimension with the code stored as a bit (-1 becomes 1)."""
    return keyed_dimension(stage(spark, sf_dir), bit_compat(BY_NAME["DimEventType"])).df


_OBSERVED = O.staged() + """
SELECT DISTINCT
  CAST(strftime(make_date(CAST(year AS INT), CAST(month AS INT), CAST(day AS INT)), '%Y%m%d') AS INT) AS DateKey,
  make_date(CAST(year AS INT), CAST(month AS INT), CAST(day AS INT)) AS FullDate,
  CAST(year AS INT) AS year, CAST(month AS SMALLINT) AS month, CAST(day AS SMALLINT) AS day
FROM stage
WHERE year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL AND year >= 1753
  AND TRY_CAST(lpad(CAST(CAST(year AS INT) AS VARCHAR), 4, '0') || '-' || CAST(month AS INT) || '-' || CAST(day AS INT) AS DATE) IS NOT NULL
  AND year BETWEEN 1900 AND 2100 AND month BETWEEN 1 AND 12 AND day BETWEEN 1 AND 31
"""


@register("dim_date_observed", _OBSERVED)
def dim_date_observed(spark, sf_dir):
    """D-Date (observed): distinct real dates present in staging, with key and parts."""
    s = stage(spark, sf_dir)
    y, m, d = F.col("year"), F.col("month"), F.col("day")
    full = parts_date(y, m, d)
    return (s.where(full.isNotNull() & parts_in_range(y, m, d))
            .select(F.date_format(full, "yyyyMMdd").cast("int").alias("DateKey"),
                    full.alias("FullDate"), y.cast("int").alias("year"),
                    m.cast("short").alias("month"), d.cast("short").alias("day"))
            .distinct())


_GROUP_IN_USE = O.staged(*star_ctes("DimPerpetratorGroup", "g")) + """
SELECT PerpetratorGroupKey, GroupName FROM g
WHERE EXISTS (SELECT 1 FROM stage s WHERE g.GroupName = coalesce(s.gname, 'Perp Group Not Given'))
"""


@register("dim_group_in_use", _GROUP_IN_USE)
def dim_group_in_use(spark, sf_dir):
    """Perpetrator groups referenced by staging rows, with their keys."""
    dim = dimension(spark, sf_dir, "DimPerpetratorGroup").df
    return members_in_use(dim, stage(spark, sf_dir), [("GroupName", F.coalesce(F.col("gname"), F.lit(GROUP_DEFAULT)))])


_LOC_IN_USE = O.staged(*star_ctes("DimLocation", "l")) + """
SELECT * FROM l
WHERE EXISTS (SELECT 1 FROM stage s WHERE l.country = s.country AND l.region = s.region
  AND l.City = s.city AND l.Province = s.provstate
  AND coalesce(l.Latitude, 0) = coalesce(s.latitude, 0)
  AND coalesce(l.Longitude, 0) = coalesce(s.longitude, 0))
"""


@register("dim_location_in_use", _LOC_IN_USE)
def dim_location_in_use(spark, sf_dir):
    """Locations referenced by staging rows; coordinates compare NULL as 0,
    a NULL province never matches."""
    dim = dimension(spark, sf_dir, "DimLocation").df
    pairs = [("country", "country"), ("region", "region"), ("City", "city"), ("Province", "provstate"),
             ("Latitude", "latitude"), ("Longitude", "longitude")]
    return members_in_use(dim, stage(spark, sf_dir), pairs, null_as={"Latitude": 0.0, "Longitude": 0.0})


_MIN_KEY = O.staged(*star_ctes("DimLocation", "l")) + """
SELECT country, region, City, min(LocationKey) AS LocationKey FROM l GROUP BY country, region, City
"""


@register("agg_min_key", _MIN_KEY)
def agg_min_key(spark, sf_dir):
    """A2: smallest location key per (country, region, city)."""
    return unique_keys(dimension(spark, sf_dir, "DimLocation").df, ["country", "region", "City"], "LocationKey")

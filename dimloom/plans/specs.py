"""The incident star: 17 dimension specs over the staging table, and the
lookups that resolve an event to their keys. (The date dimension is a
calendar; its key is computed, see ``functions.dates``.)"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from dimloom.operators.dims import DimSpec, Out, label_case
from dimloom.operators.fact import LookupSpec

c = F.col


def _nn(*names):
    return lambda: F.expr(" AND ".join(f"{n} IS NOT NULL" for n in names))


def _in01(name):
    return lambda: c(name).isin(0, 1)


# Default labels and code descriptions of the incident star.
ATTACK_DEFAULT = "Attack Type Not Given"
TARGET_DEFAULT = "Target Type Not Given"
WEAPON_DEFAULT = "Weapon Type Not Given"
WEAPON_SUB_DEFAULT = "No Data for Weapon Subtype"
TARGET_SUB_DEFAULT = "No Data for Target Subtype"
GROUP_DEFAULT = "Perp Group Not Given"
HOSTAGE_NULL_CODE = 2
SUCCESS_LABELS = [(1, "Successful"), (0, "Unsuccessful")]
SUICIDE_LABELS = [(1, "Suicide Attack"), (0, "Not a Suicide Attack")]
PROPERTY_LABELS = [(1, "Property Damaged"), (0, "No Property Damage"), (-9, "No Data")]
HOSTAGE_LABELS = [(1, "Hostage Situation"), (0, "No Hostage Situation"), (-9, "Unknown")]
HOSTAGE_NULL_LABEL = "No Data Given"
HOSTAGE_ELSE_LABEL = "Invalid Code"
DOUBT_LABELS = [(1, "Doubt Terrorism"), (0, "No Doubt"), (-9, "Unknown")]
MULTIPLE_LABELS = [(1, "Multiple Incident"), (0, "Single Incident"), (-1, "Unknown")]
EXTENDED_LABELS = [(1, "Extended Incident"), (0, "Not Extended")]
ATTACK_SUCCESS_LABELS = [(1, "Attack Successful"), (0, "Attack Failed")]
UNKNOWN = "Unknown"


def _code_label(name, key, code_out, code_src, label_out, label_src, default=None,
                code_default=None, where=None, **kw):
    code_expr = (lambda: F.coalesce(c(code_src), F.lit(code_default))) if code_default is not None \
        else (lambda: c(code_src))
    label_expr = (lambda: F.coalesce(c(label_src), F.lit(default))) if default is not None \
        else (lambda: c(label_src))
    return DimSpec(
        name=name, key=key,
        columns=(Out(code_out, code_expr, "int"), Out(label_out, label_expr, "string", 100)),
        natural=(code_out,), where=where, **kw)


def _flag(name, key, code_out, src, labels, dtype="short", null_label=None, else_label=None,
          where=None, code_default=None, **kw):
    code_expr = (lambda: F.coalesce(c(src), F.lit(code_default))) if code_default is not None \
        else (lambda: c(src))
    label_out = kw.pop("label_out", "Description")
    return DimSpec(
        name=name, key=key,
        columns=(Out(code_out, code_expr, dtype),
                 Out(label_out, label_case(lambda: c(src), labels, null_label, else_label), "string")),
        natural=(code_out,), where=where, **kw)


COUNTRY = _code_label("DimCountry", "CountryKey", "GTDCountryCode", "country", "CountryName",
                      "country_txt", where=_nn("country", "country_txt"))
REGION = _code_label("DimRegion", "RegionKey", "region", "region", "RegionName", "region_txt",
                     where=_nn("region", "region_txt"))
ATTACK_TYPE = _code_label("DimAttackType", "AttackTypeKey", "attacktype1", "attacktype1",
                          "AttackTypeLabel", "attacktype1_txt", ATTACK_DEFAULT, where=_nn("attacktype1"))
TARGET_TYPE = _code_label("DimTargetType", "TargetTypeKey", "targtype1", "targtype1",
                          "TargetTypeLabel", "targtype1_txt", TARGET_DEFAULT, where=_nn("targtype1"))
WEAPON_TYPE = _code_label("DimWeaponType", "WeaponTypeKey", "weaptype1", "weaptype1",
                          "WeaponTypeLabel", "weaptype1_txt", WEAPON_DEFAULT, where=_nn("weaptype1"))
WEAPON_SUBTYPE = _code_label("DimWeaponSubType", "WeaponSubTypeKey", "weapsubtype1", "weapsubtype1",
                             "WeaponSubTypeLabel", "weapsubtype1_txt", WEAPON_SUB_DEFAULT, code_default=0)
TARGET_SUBTYPE = _code_label("DimTargetSubType", "TargetSubTypeKey", "targsubtype1", "targsubtype1",
                             "TargetSubTypeLabel", "targsubtype1_txt", TARGET_SUB_DEFAULT, code_default=0)
GROUP = DimSpec(
    name="DimPerpetratorGroup", key="PerpetratorGroupKey",
    columns=(Out("GroupName", lambda: F.coalesce(c("gname"), F.lit(GROUP_DEFAULT)), "string"),),
    natural=("GroupName",), load_mode="if_empty")
SUCCESS = _flag("DimSuccess", "SuccessKey", "IsSuccessful", "success", SUCCESS_LABELS)
SUICIDE = _flag("DimSuicide", "SuicideKey", "IsSuicide", "suicide", SUICIDE_LABELS,
                else_label=UNKNOWN, where=_in01("suicide"))
PROPERTY = _flag("DimPropertyDamage", "PropertyDamageKey", "PropertyDamageCode", "property",
                 PROPERTY_LABELS)
HOSTAGE = _flag("DimHostageSituation", "HostageSituationKey", "HostageSituationCode", "ishostkid",
                HOSTAGE_LABELS, null_label=HOSTAGE_NULL_LABEL, else_label=HOSTAGE_ELSE_LABEL,
                code_default=HOSTAGE_NULL_CODE)
DOUBT = _flag("DimDoubtTerrorism", "DoubtTerrorismKey", "DoubtTerrorismCode", "doubtterr", DOUBT_LABELS)
EVENT_TYPE = _flag("DimEventType", "EventTypeKey", "IsMultiple", "multiple", MULTIPLE_LABELS)
EXTENDED = _flag("DimExtendedIncident", "ExtendedIncidentKey", "IsExtended", "extended", EXTENDED_LABELS)
ATTACK_SUCCESS = _flag("DimAttackSuccessType", "AttackSuccessTypeKey", "SuccessCode", "success",
                       ATTACK_SUCCESS_LABELS, dtype="int", else_label=UNKNOWN, where=_in01("success"),
                       label_out="SuccessLabel", load_mode="if_empty")
LOCATION = DimSpec(
    name="DimLocation", key="LocationKey",
    columns=(Out("country", lambda: c("country"), "int"),
             Out("region", lambda: c("region"), "int"),
             Out("City", lambda: c("city"), "string"),
             Out("Province", lambda: c("provstate"), "string"),
             Out("Latitude", lambda: c("latitude"), "double"),
             Out("Longitude", lambda: c("longitude"), "double")),
    natural=("country", "region", "City", "Province", "Latitude", "Longitude"),
    where=_nn("country", "region", "city"), load_mode="if_empty")
# Province, Latitude and Longitude may be NULL in a member; only the first
# three columns are required.
LOCATION = replace(LOCATION, drop_null_natural=False)

DIMENSIONS = [COUNTRY, REGION, ATTACK_TYPE, TARGET_TYPE, WEAPON_TYPE, GROUP, SUCCESS, SUICIDE,
              PROPERTY, HOSTAGE, DOUBT, EVENT_TYPE, EXTENDED, WEAPON_SUBTYPE, TARGET_SUBTYPE,
              ATTACK_SUCCESS, LOCATION]
BY_NAME = {d.name: d for d in DIMENSIONS}


def bit_compat(spec: DimSpec) -> DimSpec:
    """Store the code as a bit would: any non-zero code becomes 1."""
    code = spec.columns[0]
    src = code.expr
    bit = Out(code.name, lambda: F.when(src() != 0, F.lit(1)).when(src() == 0, F.lit(0)), code.dtype)
    return replace(spec, columns=(bit,) + spec.columns[1:], on_conflict="keep_all")


# Fact lookups, in the fact's column order. Every lookup reduces its dimension
# to one key per natural key first (smallest key), so no lookup can fan out.
# Which columns a lookup matches, the measures and the fact's column order.
LOOKUPS = [
    LookupSpec("DimLocation", "LocationKey", (("country", "country"), ("region", "region"), ("City", "city")),
               how="inner"),
    LookupSpec("DimCountry", "CountryKey", (("GTDCountryCode", "country"),), carry=("CountryName",)),
    LookupSpec("DimAttackType", "AttackTypeKey", (("attacktype1", "attacktype1"),)),
    LookupSpec("DimTargetType", "TargetTypeKey", (("targtype1", "targtype1"),)),
    LookupSpec("DimTargetSubType", "TargetSubTypeKey", (("targsubtype1", "targsubtype1"),), defaults={0: 0}),
    LookupSpec("DimWeaponType", "WeaponTypeKey", (("weaptype1", "weaptype1"),)),
    LookupSpec("DimWeaponSubType", "WeaponSubTypeKey", (("weapsubtype1", "weapsubtype1"),), defaults={0: 0}),
    LookupSpec("DimPerpetratorGroup", "PerpetratorGroupKey", (("GroupName", "gname"),),
               defaults={0: GROUP_DEFAULT}),
    LookupSpec("DimSuccess", "SuccessKey", (("IsSuccessful", "success"),)),
    LookupSpec("DimSuicide", "SuicideKey", (("IsSuicide", "suicide"),)),
    LookupSpec("DimPropertyDamage", "PropertyDamageKey", (("PropertyDamageCode", "property"),)),
    LookupSpec("DimHostageSituation", "HostageSituationKey", (("HostageSituationCode", "ishostkid"),),
               defaults={0: HOSTAGE_NULL_CODE}),
    LookupSpec("DimDoubtTerrorism", "DoubtTerrorismKey", (("DoubtTerrorismCode", "doubtterr"),)),
    LookupSpec("DimEventType", "EventTypeKey", (("IsMultiple", "multiple"),)),
    LookupSpec("DimExtendedIncident", "ExtendedIncidentKey", (("IsExtended", "extended"),)),
    LookupSpec("DimAttackSuccessType", "AttackSuccessTypeKey", (("SuccessCode", "success"),)),
]
LOOKUP_BY_DIM = {lk.dim: lk for lk in LOOKUPS}

# The default location lookup matches on (country, region, city) and takes the
# smallest key, so events in one city share a location whatever their
# coordinates. The precise variant matches all six columns, NULL-safely.
PRECISE_LOCATION = LookupSpec(
    "DimLocation", "LocationKey",
    (("country", "country"), ("region", "region"), ("City", "city"), ("Province", "provstate"),
     ("Latitude", "latitude"), ("Longitude", "longitude")),
    how="inner", null_safe=True)

MEASURES = ["num_killed", "num_wounded", "num_us_killed", "num_us_wounded",
            "num_terrorists_killed", "num_terrorists_wounded"]
FACT_COLUMNS = ["eventid", "DateKey", "LocationKey", "CountryKey", "CountryName", "GTDCountryCode",
                "AttackTypeKey", "TargetTypeKey", "TargetSubTypeKey", "WeaponTypeKey",
                "WeaponSubTypeKey", "PerpetratorGroupKey", "SuccessKey", "SuicideKey",
                "PropertyDamageKey", "HostageSituationKey", "DoubtTerrorismKey", "EventTypeKey",
                "ExtendedIncidentKey", "AttackSuccessTypeKey", *MEASURES]
# Tie-break that makes the surviving copy of a repeated event deterministic.
DEDUPE_ORDER = ["tie1", "tie2", "tie3"]

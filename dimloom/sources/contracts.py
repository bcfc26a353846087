"""Table contracts (S11): one StructType per warehouse table, text widths, and
``conform`` (P17), which shapes any frame to a contract.

Parquet tables cannot declare primary keys, foreign keys or CHECK clauses;
those rules are kept here as data and enforced by the audits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

I, S, SH, D, DT = T.IntegerType(), T.StringType(), T.ShortType(), T.DoubleType(), T.DateType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


def _code_label(key, code, label):
    return _schema((key, I, False), (code, I, False), (label, S, False))


def _flag(key, code, label="Description", code_type=SH, code_null=False):
    return _schema((key, I, False), (code, code_type, code_null), (label, S, False))


# Table columns.
SCHEMAS: dict[str, T.StructType] = {
    "DimDate": _schema(("DateKey", I, False), ("FullDate", DT, False), ("year", I, False),
                       ("month", SH, False), ("day", SH, False)),
    "DimCountry": _code_label("CountryKey", "GTDCountryCode", "CountryName"),
    "DimRegion": _code_label("RegionKey", "region", "RegionName"),
    "DimAttackType": _code_label("AttackTypeKey", "attacktype1", "AttackTypeLabel"),
    "DimTargetType": _code_label("TargetTypeKey", "targtype1", "TargetTypeLabel"),
    "DimWeaponType": _code_label("WeaponTypeKey", "weaptype1", "WeaponTypeLabel"),
    "DimPerpetratorGroup": _schema(("PerpetratorGroupKey", I, False), ("GroupName", S, False)),
    "DimSuccess": _flag("SuccessKey", "IsSuccessful"),
    "DimSuicide": _flag("SuicideKey", "IsSuicide"),
    "DimPropertyDamage": _flag("PropertyDamageKey", "PropertyDamageCode"),
    "DimHostageSituation": _flag("HostageSituationKey", "HostageSituationCode", code_null=True),
    "DimDoubtTerrorism": _flag("DoubtTerrorismKey", "DoubtTerrorismCode"),
    "DimEventType": _flag("EventTypeKey", "IsMultiple"),
    "DimExtendedIncident": _flag("ExtendedIncidentKey", "IsExtended"),
    "DimWeaponSubType": _code_label("WeaponSubTypeKey", "weapsubtype1", "WeaponSubTypeLabel"),
    "DimTargetSubType": _code_label("TargetSubTypeKey", "targsubtype1", "TargetSubTypeLabel"),
    "DimAttackSuccessType": _flag("AttackSuccessTypeKey", "SuccessCode", "SuccessLabel", code_type=I),
    "DimLocation": _schema(("LocationKey", I, False), ("country", I, False), ("region", I, False),
                           ("City", S, False), ("Province", S, True), ("Latitude", D, True),
                           ("Longitude", D, True)),
    "Fact_Terror_Events": _schema(
        ("EventID", S, False), ("DateKey", I, False), ("LocationKey", I, False),
        ("CountryKey", I, True), ("AttackTypeKey", I, True), ("TargetTypeKey", I, True),
        ("TargetSubTypeKey", I, True), ("WeaponTypeKey", I, True), ("WeaponSubTypeKey", I, True),
        ("PerpetratorGroupKey", I, True), ("SuccessKey", I, True), ("SuicideKey", I, True),
        ("PropertyDamageKey", I, True), ("HostageSituationKey", I, True),
        ("DoubtTerrorismKey", I, True), ("AlternativeDesignationKey", I, True),
        ("EventTypeKey", I, True), ("ExtendedIncidentKey", I, True),
        ("AttackSuccessTypeKey", I, True), ("NumKilled", I, True), ("NumWounded", I, True),
        ("NumUSKilled", I, True), ("NumUSWounded", I, True), ("NumTerroristsKilled", I, True),
        ("NumTerroristsWounded", I, True)),
    "ETLLog": _schema(("ETLLogID", T.LongType(), False), ("ETLDateAndTime", T.TimestampType(), True),
                      ("ETLAction", S, True), ("ETLLogMessage", S, True)),
}

# Declared text widths per table.
WIDTHS: dict[str, dict[str, int]] = {
    "DimCountry": {"CountryName": 100},
    "DimRegion": {"RegionName": 100},
    "DimAttackType": {"AttackTypeLabel": 100},
    "DimTargetType": {"TargetTypeLabel": 100},
    "DimWeaponType": {"WeaponTypeLabel": 100},
    "DimPerpetratorGroup": {"GroupName": 255},
    "DimSuccess": {"Description": 50},
    "DimSuicide": {"Description": 50},
    "DimPropertyDamage": {"Description": 50},
    "DimHostageSituation": {"Description": 50},
    "DimDoubtTerrorism": {"Description": 50},
    "DimEventType": {"Description": 50},
    "DimExtendedIncident": {"Description": 50},
    "DimWeaponSubType": {"WeaponSubTypeLabel": 100},
    "DimTargetSubType": {"TargetSubTypeLabel": 100},
    "DimAttackSuccessType": {"SuccessLabel": 100},
    "DimLocation": {"City": 200, "Province": 200},
    "Fact_Terror_Events": {"EventID": 50},
    "ETLLog": {"ETLAction": 100, "ETLLogMessage": 2000},
}

# Text that lookups and anti joins match: kept whole whatever its declared width
# (the width audit counts it), since a cut key would no longer match its source.
KEY_TEXT: dict[str, set[str]] = {
    "DimPerpetratorGroup": {"GroupName"},
    "DimLocation": {"City", "Province"},
    "Fact_Terror_Events": {"EventID"},
}


def cut_widths(name: str) -> dict[str, int]:
    """Declared widths of a table's text columns that are no part of a key."""
    return {c: w for c, w in WIDTHS.get(name, {}).items() if c not in KEY_TEXT.get(name, ())}


# Fact foreign keys, (fact column, dimension, dimension key).
FOREIGN_KEYS = [
    ("DateKey", "DimDate", "DateKey"),
    ("LocationKey", "DimLocation", "LocationKey"),
    ("CountryKey", "DimCountry", "CountryKey"),
    ("AttackTypeKey", "DimAttackType", "AttackTypeKey"),
    ("TargetTypeKey", "DimTargetType", "TargetTypeKey"),
    ("TargetSubTypeKey", "DimTargetSubType", "TargetSubTypeKey"),
    ("WeaponTypeKey", "DimWeaponType", "WeaponTypeKey"),
    ("WeaponSubTypeKey", "DimWeaponSubType", "WeaponSubTypeKey"),
    ("PerpetratorGroupKey", "DimPerpetratorGroup", "PerpetratorGroupKey"),
    ("SuccessKey", "DimSuccess", "SuccessKey"),
    ("SuicideKey", "DimSuicide", "SuicideKey"),
    ("PropertyDamageKey", "DimPropertyDamage", "PropertyDamageKey"),
    ("HostageSituationKey", "DimHostageSituation", "HostageSituationKey"),
    ("DoubtTerrorismKey", "DimDoubtTerrorism", "DoubtTerrorismKey"),
    ("EventTypeKey", "DimEventType", "EventTypeKey"),
    ("ExtendedIncidentKey", "DimExtendedIncident", "ExtendedIncidentKey"),
    ("AttackSuccessTypeKey", "DimAttackSuccessType", "AttackSuccessTypeKey"),
]

PRIMARY_KEYS = {name: [schema.fields[0].name] for name, schema in SCHEMAS.items()}

# Fact view column -> fact table column.
FACT_RENAMES = {
    "eventid": "EventID",
    "num_killed": "NumKilled",
    "num_wounded": "NumWounded",
    "num_us_killed": "NumUSKilled",
    "num_us_wounded": "NumUSWounded",
    "num_terrorists_killed": "NumTerroristsKilled",
    "num_terrorists_wounded": "NumTerroristsWounded",
}


def _shape(c: Column, source: T.DataType | None, target: T.DataType) -> Column:
    if source is not None and source == target:
        return c
    if isinstance(target, T.StringType):
        return c.cast("string")
    return c.try_cast(target)


def conform(df: DataFrame, schema: T.StructType, widths: dict[str, int] | None = None) -> DataFrame:
    """Select the contract's columns in order, cast each to its type
    (impossible values become NULL rather than failing the load), cut text to
    its declared width, and add absent nullable columns as NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    widths = widths or {}
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = _shape(F.col(f.name), have[f.name], f.dataType)
        elif f.nullable:
            c = F.lit(None).cast(f.dataType)
        else:
            raise ValueError(f"column {f.name} is required by the contract but absent")
        if f.name in widths:
            c = F.substring(c, 1, widths[f.name])
        cols.append(c.alias(f.name))
    return df.select(*cols)


def cast_losses(df: DataFrame, schema: T.StructType) -> Column:
    """Per row, how many values ``conform`` would turn into NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    lost = [(F.col(f.name).isNotNull() & _shape(F.col(f.name), have[f.name], f.dataType).isNull()).cast("int")
            for f in schema.fields if f.name in have and have[f.name] != f.dataType]
    return sum(lost, F.lit(0))


def not_null_columns(name: str) -> list[str]:
    return [f.name for f in SCHEMAS[name].fields if not f.nullable]

"""Registry entries for the cleaning steps: each returns the table as it stands
after the named step (steps always run in their fixed order)."""

from __future__ import annotations

from dimloom.operators.clean import clean
from dimloom.plans import oracle_base as O
from dimloom.plans.pipeline import filled, raw, stage
from dimloom.plans.registry import register

_GEO_ONLY = O.select_over(
    {c: O.num(c) for c in O.BINARY_TEXT},
    "norm WHERE latitude IS NOT NULL AND longitude IS NOT NULL")


@register("clean_text", O.with_(O.RAW, O.NORM) + "SELECT * FROM norm")
def clean_text(spark, sf_dir):
    """P1 + P2: text lower-cased and stripped, placeholders NULL."""
    return clean(raw(spark, sf_dir), "text")


@register("clean_drop_null_geo", O.with_(O.RAW, O.NORM) + _GEO_ONLY)
def clean_drop_null_geo(spark, sf_dir):
    """P3 (binary codes) + P4: rows without both coordinates dropped."""
    return clean(raw(spark, sf_dir), "geo")


@register("clean_fill", O.with_(O.RAW, O.NORM, O.FILLED) + "SELECT * FROM filled")
def clean_fill(spark, sf_dir):
    """P5: NULL city / province filled with the default (the saved audit input)."""
    return filled(spark, sf_dir)


@register("clean_numeric", O.with_(O.RAW, O.NORM, O.FILLED, O.NUMBERS) + "SELECT * FROM numbers")
def clean_numeric(spark, sf_dir):
    """P3 over the numeric columns: numeric text converted, the rest NULL."""
    return clean(filled(spark, sf_dir), "numeric", start="numeric")


@register("clean_rename", O.with_(O.RAW, O.NORM, O.FILLED, O.NUMBERS, O.RENAMED) + "SELECT * FROM renamed")
def clean_rename(spark, sf_dir):
    """P6 + P7: renamed columns, drop list applied."""
    return clean(filled(spark, sf_dir), "rename", start="numeric")


@register("clean_sparse_columns", O.staged() + "SELECT * FROM stage")
def clean_sparse_columns(spark, sf_dir):
    """Columns at least 80% NULL dropped. The table is written once up to the
    drop list; the NULL shares are measured on that copy and the sparse columns
    are dropped on read (no second pass over the raw joins)."""
    return stage(spark, sf_dir, protect=())

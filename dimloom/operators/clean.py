"""Cleaning operators (P1-P9) and the cleaning pipeline.

Each step is a projection or filter, so a chain of steps is one lazy plan that
Catalyst fuses into a single scan-project-filter stage. Only the sparse-column
drop (P8) needs an action: its output schema depends on the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimloom.functions.text import (
    EXTRA_NULL_TOKENS,
    PLACEHOLDERS,
    null_if_in,
    strip_lower,
    to_number,
)
from dimloom.operators.observed import observed

# Column lists and names of the incident cleaning contract.
BINARY_COLUMNS = ["claimed", "ishostkid", "INT_ANY", "INT_MISC", "INT_IDEO", "INT_LOG",
                  "property", "doubtterr", "vicinity"]
NUMERIC_COLUMNS = ["iyear", "imonth", "iday", "nkill", "nkillus", "nkillter",
                   "nwound", "nwoundus", "nwoundte", "propvalue", "nperps",
                   "nperpcap", "ransomamt", "ransomamtus", "ransompaid", "ransompaidus"]
GEO_COLUMNS = ["latitude", "longitude"]
FILL_DEFAULTS = {"city": "unknown", "provstate": "unknown"}
RENAMES = {
    "iyear": "year",
    "imonth": "month",
    "iday": "day",
    "nkill": "num_killed",
    "nwound": "num_wounded",
    "nkillus": "num_us_killed",
    "nwoundus": "num_us_wounded",
    "nkillter": "num_terrorists_killed",
    "nwoundte": "num_terrorists_wounded",
}
DROP_COLUMNS = [
    "summary", "motive", "addnotes", "propcomment", "weapdetail",
    "target1", "target2", "target3", "corp1", "corp2", "corp3",
    "claimmode_txt", "claimmode2", "claimmode3",
    "scite1", "scite2", "scite3", "approxdate", "resolution", "ransomnote",
    "gsubname", "gsubname2", "gsubname3", "related", "location",
    "vicinity", "specificity",
    "dbsource", "INT_LOG", "INT_IDEO", "INT_MISC", "INT_ANY",
    "attacktype2", "attacktype2_txt", "attacktype3", "attacktype3_txt",
]
SPARSE_THRESHOLD = 0.8
ALIGNMENT_PAIRS = [
    ("country", "country_txt"),
    ("region", "region_txt"),
    ("attacktype1", "attacktype1_txt"),
    ("targtype1", "targtype1_txt"),
    ("targsubtype1", "targsubtype1_txt"),
    ("weaptype1", "weaptype1_txt"),
    ("weapsubtype1", "weapsubtype1_txt"),
]

# Pipeline steps in the order they are applied.
STEPS = ("text", "binary", "geo", "fill", "numeric", "rename", "sparse")


def _present(df: DataFrame, cols) -> list[str]:
    """Steps silently skip columns that are absent."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def _replace(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """One projection that swaps the given columns in place, keeping order."""
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def normalize_text(df: DataFrame, cols=None, placeholders=PLACEHOLDERS,
                   extra_nulls=EXTRA_NULL_TOKENS) -> DataFrame:
    """P1 + P2: lower-case and strip every text column, then map placeholder
    texts to NULL. NULL stays NULL throughout."""
    cols = _present(df, cols) if cols is not None else string_columns(df)
    nulls = tuple(dict.fromkeys(tuple(placeholders) + tuple(extra_nulls)))
    stripped = _replace(df, {c: strip_lower(F.col(c)) for c in cols})
    return _replace(stripped, {c: null_if_in(F.col(c), nulls) for c in cols})


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """Numbers stay, numeric text converts, anything else becomes NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return _replace(df, {c: to_number(F.col(c), types[c]) for c in _present(df, cols)})


def require_not_null(df: DataFrame, cols=GEO_COLUMNS) -> DataFrame:
    """Drop rows with a NULL in any of ``cols``."""
    return df.na.drop(how="any", subset=_present(df, cols))


def fill_defaults(df: DataFrame, defaults=None) -> DataFrame:
    """P5: replace NULLs by per-column defaults."""
    defaults = FILL_DEFAULTS if defaults is None else defaults
    present = {c: v for c, v in defaults.items() if c in df.columns}
    return df.na.fill(present) if present else df


def rename(df: DataFrame, mapping=None) -> DataFrame:
    """Rename columns; absent names are ignored."""
    mapping = RENAMES if mapping is None else mapping
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_columns(df: DataFrame, cols=None) -> DataFrame:
    """Drop listed columns; absent names are ignored."""
    return df.drop(*_present(df, DROP_COLUMNS if cols is None else cols))


def null_profile(df: DataFrame) -> DataFrame:
    """A5: NULL count and share per column, computed in one aggregation pass.

    Output: (column_name, null_rows, total_rows, null_share), one row per column.
    """
    aggs = [F.count(F.lit(1)).alias("__total")]
    aggs += [F.sum(F.col(c).isNull().cast("long")).alias(f"__n{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', __n{i}" for i, c in enumerate(df.columns))
    long = one.selectExpr("__total", f"stack({len(df.columns)}, {pairs}) AS (column_name, null_rows)")
    return long.select(
        "column_name",
        F.coalesce(F.col("null_rows"), F.lit(0)).cast("long").alias("null_rows"),
        F.col("__total").cast("long").alias("total_rows"),
        F.when(F.col("__total") > 0,
               F.coalesce(F.col("null_rows"), F.lit(0)).cast("double") / F.col("__total").cast("double"))
        .alias("null_share"),
    )


@dataclass(frozen=True)
class Profile:
    """Rows of a table, and NULLs of each of its columns."""

    rows: int
    nulls: dict[str, int]

    def sparse(self, threshold: float = SPARSE_THRESHOLD, protect=()) -> tuple[list[str], list[str]]:
        """Columns whose NULL share is >= threshold: (to drop, protected ones)."""
        hits = [c for c, n in self.nulls.items() if self.rows and n / self.rows >= threshold]
        return [c for c in hits if c not in protect], [c for c in hits if c in protect]

    def frame(self, spark: SparkSession) -> DataFrame:
        """The profile as ``null_profile`` returns it."""
        rows = [(c, n, self.rows, n / self.rows if self.rows else None) for c, n in self.nulls.items()]
        return spark.createDataFrame(rows, "column_name string, null_rows long, total_rows long, null_share double")


def write_profiled(df: DataFrame, path: str, mode: str = "errorifexists") -> Profile:
    """A5 while writing: the rows and NULLs of each column are counted as the table is written, without a scan of its own."""
    seen = Observation()
    counts = [F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.mode(mode).option("compression", "zstd").parquet(path)
    got = observed(seen) or df.sparkSession.read.schema(df.schema).parquet(path).agg(F.count(F.lit(1)).alias("rows"), *counts).first()
    return Profile(got["rows"], {c: got["rows"] - got[f"n{i}"] for i, c in enumerate(df.columns)})


def sparse_columns(df: DataFrame, threshold: float = SPARSE_THRESHOLD, protect=()) -> tuple[list[str], list[str]]:
    """Columns whose NULL share is >= threshold; returns (to_drop, protected_hits).

    One aggregation; the collected result has one row per column, so its size
    is bounded by the schema, not by the data.
    """
    rows = null_profile(df).collect()
    return Profile(rows[0]["total_rows"] if rows else 0, {r["column_name"]: r["null_rows"] for r in rows}).sparse(threshold, tuple(protect))


def drop_sparse(df: DataFrame, threshold: float = SPARSE_THRESHOLD, protect=()) -> tuple[DataFrame, list[str]]:
    """Drop columns that are at least ``threshold`` NULL (protected ones stay)."""
    to_drop, _ = sparse_columns(df, threshold, protect)
    return df.drop(*to_drop), to_drop


@dataclass
class CleanConfig:
    binary: list[str] = field(default_factory=lambda: list(BINARY_COLUMNS))
    numeric: list[str] = field(default_factory=lambda: list(NUMERIC_COLUMNS))
    geo: list[str] = field(default_factory=lambda: list(GEO_COLUMNS))
    fill: dict[str, str] = field(default_factory=lambda: dict(FILL_DEFAULTS))
    renames: dict[str, str] = field(default_factory=lambda: dict(RENAMES))
    drop: list[str] = field(default_factory=lambda: list(DROP_COLUMNS))
    sparse_threshold: float = SPARSE_THRESHOLD
    protect: tuple[str, ...] = ()


def clean(df: DataFrame, upto: str = "sparse", config: CleanConfig | None = None,
          start: str = "text") -> DataFrame:
    """Run the cleaning steps in their fixed order from ``start`` up to and
    including ``upto`` (``start`` lets a saved intermediate continue).

    Order matters: text first (so placeholders are recognised), binary codes,
    coordinates, defaults, then the numeric columns -- after the numeric audit
    has looked at their raw text -- then renames, the drop list and finally
    the sparse drop.
    """
    cfg = config or CleanConfig()
    for step in (upto, start):
        if step not in STEPS:
            raise ValueError(f"unknown cleaning step {step!r}; expected one of {STEPS}")
    first, stop = STEPS.index(start), STEPS.index(upto)

    def wanted(i: int) -> bool:
        return first <= i <= stop

    out = normalize_text(df) if wanted(0) else df
    if wanted(1):
        out = coerce_numeric(out, cfg.binary)
    if wanted(2):
        out = require_not_null(out, cfg.geo)
    if wanted(3):
        out = fill_defaults(out, cfg.fill)
    if wanted(4):
        out = coerce_numeric(out, cfg.numeric)
    if wanted(5):
        out = drop_columns(rename(out, cfg.renames), cfg.drop)
    if wanted(6):
        out, _ = drop_sparse(out, cfg.sparse_threshold, cfg.protect)
    return out

"""Shared steps of the warehouse plan.

``stage`` materialises the cleaned table once per session and input folder as
parquet under the shared checkpoint folder: later steps (dimensions, fact,
audits) read that narrow columnar table instead of re-running the fixture
joins and cleaning, which also cuts the lineage a lost executor would have to
recompute.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession

from dimloom.operators.clean import SPARSE_THRESHOLD, Profile, clean, write_profiled
from dimloom.session import new_scratch_path, path_exists
from dimloom.sources.fixtures import raw_incidents

# Staging columns the warehouse reads; the sparse drop must never remove them.
WAREHOUSE_COLUMNS = (
    "eventid", "year", "month", "day", "country", "country_txt", "region", "region_txt",
    "provstate", "city", "latitude", "longitude", "attacktype1", "attacktype1_txt",
    "targtype1", "targtype1_txt", "targsubtype1", "targsubtype1_txt", "weaptype1",
    "weaptype1_txt", "weapsubtype1", "weapsubtype1_txt", "gname", "success", "suicide",
    "multiple", "extended", "property", "doubtterr", "ishostkid", "num_killed", "num_wounded",
    "num_us_killed", "num_us_wounded", "num_terrorists_killed", "num_terrorists_wounded",
    "tie1", "tie2", "tie3",
)

_lock = threading.RLock()
# (app, input folder) -> path of the table cleaned up to the defaults (audit input)
_filled: dict[tuple[str, str], str] = {}
# (app, input folder) -> path of the cleaned table written up to the drop list
_renamed: dict[tuple[str, str], str] = {}
# (app, input folder) -> rows and NULLs of that table, counted while it was written
_profiles: dict[tuple[str, str], Profile] = {}


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_incidents(spark, sf_dir)


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table cleaned up to the defaults (text, codes, coordinates,
    defaults), numbers still as text: the input of the alignment and numeric
    audits and of the quarantine. Written once per session, so the audits
    read one columnar copy instead of re-running the raw joins each."""
    base = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    with _lock:
        path = _filled.get(base)
        if path is None or not path_exists(spark, path):
            path = new_scratch_path(spark, "filled")
            clean(raw(spark, sf_dir), "fill").write.mode("errorifexists").option("compression", "zstd").parquet(path)
            _filled[base] = path
    return spark.read.parquet(path)


def build_staging(spark: SparkSession, sf_dir: str) -> tuple[str, Profile]:
    """Clean the raw table up to the drop list and write it; returns its path and
    its profile, counted while writing. Where the filled table is written already,
    cleaning continues from it; else nothing is written in between.

    The sparse-column decision is left to the reader: it depends on which
    columns are protected, the written table does not.
    """
    path = new_scratch_path(spark, "staging")
    held = _filled.get((spark.sparkContext.applicationId, os.path.abspath(sf_dir)))
    if held is not None and path_exists(spark, held):
        return path, write_profiled(clean(filled(spark, sf_dir), "rename", start="numeric"), path)
    return path, write_profiled(clean(raw(spark, sf_dir), "rename"), path)


def _staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Profile]:
    base = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    with _lock:
        path = _renamed.get(base)
        if path is None or not path_exists(spark, path):
            _renamed[base], _profiles[base] = path, _ = build_staging(spark, sf_dir)
        return spark.read.parquet(path), _profiles[base]


def stage(spark: SparkSession, sf_dir: str, protect=WAREHOUSE_COLUMNS) -> DataFrame:
    """The staging table for ``sf_dir``, built on first use in this session.

    The table is written once, and its NULLs are counted while it is written; the
    sparse columns are dropped on read, which column pruning makes free.
    ``protect`` lists columns the sparse drop must keep (default: the ones the
    warehouse reads).
    """
    written, profile = _staged(spark, sf_dir)
    return written.drop(*profile.sparse(SPARSE_THRESHOLD, tuple(protect))[0])


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: the NULL shares of the staging table before the sparse drop, as counted while it was written."""
    return _staged(spark, sf_dir)[1].frame(spark)


def renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written table before the sparse drop (every column)."""
    return _staged(spark, sf_dir)[0]


def forget_staging() -> None:
    """Drop the memo (bench uses it to time staging from scratch)."""
    with _lock:
        _filled.clear()
        _renamed.clear()
        _profiles.clear()

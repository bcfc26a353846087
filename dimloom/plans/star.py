"""Building the star: keyed dimensions over the staging table, written once per
session to the shared scratch folder (as a load would publish them), and the
fact view over them."""

from __future__ import annotations

import os
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from dimloom.functions.dates import calendar
from dimloom.operators.dims import keyed_dimension
from dimloom.operators.fact import fact_view
from dimloom.operators.keys import Keyed
from dimloom.plans.pipeline import stage
from dimloom.plans.specs import BY_NAME, DEDUPE_ORDER, FACT_COLUMNS, LOOKUPS
from dimloom.session import new_scratch_path, path_exists

_lock = threading.Lock()
_name_locks: dict[tuple[str, str, str], threading.Lock] = {}
_dims: dict[tuple[str, str, str], tuple[str, int, int | None]] = {}
# Dimensions are small jobs; several are built at once so their stages overlap.
BUILD_THREADS = 8


def _memo_key(spark: SparkSession, sf_dir: str, name: str):
    return (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name)


def dimension(spark: SparkSession, sf_dir: str, name: str) -> Keyed:
    """One keyed dimension of the star, built from staging on first use."""
    spec = BY_NAME[name]
    key = _memo_key(spark, sf_dir, name)
    with _lock:
        lock = _name_locks.setdefault(key, threading.Lock())
    with lock:
        hit = _dims.get(key)
        if hit is None or not path_exists(spark, hit[0]):
            keyed = keyed_dimension(stage(spark, sf_dir), spec)
            path = new_scratch_path(spark, name)
            keyed.df.write.parquet(path)
            hit = (path, keyed.rows, keyed.text_bytes)
            _dims[key] = hit
    unique = spec.natural if spec.on_conflict == "min_label" else ()
    return Keyed(spark.read.parquet(hit[0]), hit[1], spec.key, hit[2], unique)


def dimensions(spark: SparkSession, sf_dir: str, names=None) -> dict[str, Keyed]:
    """Several dimensions, built concurrently (each is its own set of small jobs)."""
    names = list(names or [lk.dim for lk in LOOKUPS])
    stage(spark, sf_dir)  # build staging once before the threads start
    with ThreadPoolExecutor(max_workers=min(BUILD_THREADS, len(names))) as pool:
        built = list(pool.map(lambda n: dimension(spark, sf_dir, n), names))
    return dict(zip(names, built))


def date_dimension(spark: SparkSession) -> Keyed:
    """The calendar date dimension (fixed range, computed, not loaded row by row)."""
    from dimloom.functions.dates import CALENDAR_END, CALENDAR_START

    rows = (CALENDAR_END - CALENDAR_START).days + 1
    return Keyed(calendar(spark), rows, "DateKey")


def star_fact(spark: SparkSession, sf_dir: str, dedupe_first: bool = True) -> DataFrame:
    """F1 over this session's staging and dimensions."""
    return fact_view(stage(spark, sf_dir), dimensions(spark, sf_dir), LOOKUPS, FACT_COLUMNS,
                     DEDUPE_ORDER, dedupe_first, written=True)


_facts: dict[tuple[str, str, str], str] = {}


def saved_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact view, resolved and written once per session: what audits, loads and
    roll-ups over the finished star read."""
    key = _memo_key(spark, sf_dir, "fact")
    with _lock:
        lock = _name_locks.setdefault(key, threading.Lock())
    with lock:
        path = _facts.get(key)
        if path is None or not path_exists(spark, path):
            path = new_scratch_path(spark, "fact")
            star_fact(spark, sf_dir).write.option("compression", "zstd").parquet(path)
            _facts[key] = path
    return spark.read.parquet(path)


def forget() -> None:
    with _lock:
        _dims.clear()
        _facts.clear()

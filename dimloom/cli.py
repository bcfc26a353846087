"""Command-line entry points for the three stages of a load.

    python -m dimloom.cli clean  --input raw.csv --output cleaned/ --quarantine bad/
    python -m dimloom.cli stage  --input cleaned/ --parquet staging/      (or --jdbc-url/--jdbc-table)
    python -m dimloom.cli build  --input staging/ --warehouse wh/ [--no-refresh] [--order-by col ...]

Inputs and outputs are Hadoop URIs. Reports (row counts, code/label conflicts,
bad values, sparse columns, step statuses, the run log) are computed as
DataFrames; the code/label conflicts and bad values are written whole beside
the output (``<output>_reports``) and a sample of them is shown.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from dimloom.operators import audit as A
from dimloom.operators.clean import (
    ALIGNMENT_PAIRS, GEO_COLUMNS, NUMERIC_COLUMNS, CleanConfig, clean, write_profiled)
from dimloom.plans.pipeline import WAREHOUSE_COLUMNS
from dimloom.plans.specs import DEDUPE_ORDER, DIMENSIONS, FACT_COLUMNS, LOOKUPS
from dimloom.plans.warehouse import Warehouse, log_view, run_warehouse
from dimloom.session import ensure_checkpoint_dir, remove_path
from dimloom.sources.files import read_incidents, read_jdbc, write_clean, write_jdbc, write_quarantine


def _spark() -> SparkSession:
    spark = SparkSession.builder.appName("dimloom").getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def cmd_clean(spark: SparkSession, args) -> int:
    """Entry 1: clean a raw CSV, quarantine bad numbers, report, write CSV."""
    raw = read_incidents(spark, args.input, encoding=args.encoding)
    cfg = CleanConfig(protect=tuple(args.protect or ()))
    A.row_accounting(clean(raw, "text", cfg), GEO_COLUMNS).show(truncate=False)
    # One more pass over the raw file writes the table cleaned up to the
    # defaults; the audits, the quarantine and the rest of the cleaning read it.
    reports = f"{args.output.rstrip('/')}_reports"
    filled_path = f"{args.output.rstrip('/')}_filled.parquet"
    clean(raw, "fill", cfg).write.mode("overwrite").parquet(filled_path)
    filled = spark.read.parquet(filled_path)
    present = [p for p in ALIGNMENT_PAIRS if p[0] in filled.columns and p[1] in filled.columns]
    if present:
        _report(spark, A.code_label_conflicts(filled, present, list_labels=True), f"{reports}/conflicts")
    _report(spark, A.sample_bad_values(filled, NUMERIC_COLUMNS, 10), f"{reports}/bad_values")
    if args.quarantine:
        write_quarantine(A.bad_rows(filled, NUMERIC_COLUMNS), args.quarantine, mode="overwrite")
    renamed_path = f"{args.output.rstrip('/')}_renamed.parquet"
    profile = write_profiled(clean(filled, "rename", cfg, start="numeric"), renamed_path, "overwrite")
    renamed = spark.read.parquet(renamed_path)
    dropped, kept = profile.sparse(cfg.sparse_threshold, cfg.protect)
    print(f"sparse columns dropped: {dropped}; protected: {kept}")
    write_clean(renamed.drop(*dropped), args.output, "csv", mode="overwrite")
    for path in (filled_path, renamed_path):
        remove_path(spark, path)
    return 0


def _report(spark: SparkSession, rows, path: str) -> None:
    """Write a whole report; show a sample and how many rows there are."""
    rows.write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)
    print(f"{path}: {written.count()} rows")
    written.show(50, truncate=False)


def event_order(columns, wanted=None) -> list[str]:
    """The total order that picks one row of a repeated event: the columns asked for, then
    every other column by name, so that it is repeatable on any input."""
    first = [c for c in (wanted or DEDUPE_ORDER) if c in columns]
    return first + sorted(c for c in columns if c not in first and c != "eventid")


def cmd_stage(spark: SparkSession, args) -> int:
    """Entry 2: load a (cleaned) CSV into the staging table, replacing it."""
    df = read_incidents(spark, args.input, schema=None, encoding=args.encoding, multi_line=not args.one_line)
    df.printSchema()
    if args.jdbc_url:
        write_jdbc(df, args.jdbc_url, args.jdbc_table, "overwrite", jdbc_properties(args))
    else:
        df.write.mode("overwrite").parquet(args.parquet)
    return 0


def jdbc_properties(args) -> dict[str, str]:
    props = {"driver": args.jdbc_driver} if args.jdbc_driver else {}
    user, password = os.environ.get("DIMLOOM_JDBC_USER"), os.environ.get("DIMLOOM_JDBC_PASSWORD")
    if user:
        props["user"] = user
    if password:
        props["password"] = password
    return props


def cmd_build(spark: SparkSession, args) -> int:
    """Entry 3: build the warehouse from staging (or raw) rows; show statuses and log."""
    if args.jdbc_url:
        src = read_jdbc(spark, args.jdbc_url, args.jdbc_table, jdbc_properties(args), args.jdbc_split_on, args.jdbc_slices)
    elif args.input_format == "parquet":
        src = spark.read.parquet(args.input)
    else:
        src = read_incidents(spark, args.input, encoding=args.encoding, multi_line=not args.one_line)
    status = run_warehouse(spark, src, args.warehouse, DIMENSIONS, LOOKUPS, FACT_COLUMNS,
                           lambda columns: event_order(columns, args.order_by),
                           refresh=not args.no_refresh, protect=WAREHOUSE_COLUMNS)
    status.show(50, truncate=False)
    log = Warehouse(spark, args.warehouse).table("ETLLog")
    print(f"run log: {log.count()} lines, all in {args.warehouse}/ETLLog; the last of them:")
    log_view(log).orderBy(F.desc("ETLLogID")).show(50, truncate=False)
    return 0 if all(r.status >= 0 for r in status.select("status").collect()) else 1


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="dimloom")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--input", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--quarantine")
    c.add_argument("--encoding", default="ISO-8859-1")
    c.add_argument("--protect", nargs="*")
    s = sub.add_parser("stage")
    s.add_argument("--input", required=True)
    s.add_argument("--encoding", default="UTF-8")
    s.add_argument("--one-line", action="store_true", help="no field holds a newline: CSV files can be split")
    s.add_argument("--parquet")
    s.add_argument("--jdbc-url")
    s.add_argument("--jdbc-table", default="FactTerrorEvents")
    s.add_argument("--jdbc-driver")
    b = sub.add_parser("build")
    b.add_argument("--input")
    b.add_argument("--jdbc-url")
    b.add_argument("--jdbc-table", default="FactTerrorEvents")
    b.add_argument("--jdbc-driver")
    b.add_argument("--jdbc-split-on", help="number, date or timestamp column: its ranges are read by a task each")
    b.add_argument("--jdbc-slices", type=int, help="how many ranges (default: the session's parallelism)")
    b.add_argument("--order-by", nargs="*", help="columns that pick one row of a repeated event")
    b.add_argument("--one-line", action="store_true", help="no field holds a newline: CSV files can be split")
    b.add_argument("--input-format", choices=["parquet", "csv"], default="parquet")
    b.add_argument("--encoding", default="UTF-8")
    b.add_argument("--warehouse", required=True)
    b.add_argument("--no-refresh", action="store_true")
    args = p.parse_args(argv)
    if args.cmd == "stage" and not (args.parquet or args.jdbc_url):
        p.error("stage needs --parquet or --jdbc-url")
    if args.cmd == "build" and not (args.input or args.jdbc_url):
        p.error("build needs --input or --jdbc-url")
    spark = _spark()
    return {"clean": cmd_clean, "stage": cmd_stage, "build": cmd_build}[args.cmd](spark, args)


if __name__ == "__main__":
    sys.exit(main())

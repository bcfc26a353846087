"""Benchmark: time the warehouse pipeline and headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each timed step fully computes its result with a ``noop`` write (nothing is
collected to the driver). Staging and the 17 dimensions are built from
scratch and timed on their own; the queries after them read those tables.
A small untimed warm-up on sf0.001 runs first. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dimloom.plans import catalog  # noqa: E402
from dimloom.plans import pipeline, star  # noqa: E402
from dimloom.plans.specs import LOOKUPS  # noqa: E402
from dimloom.session import get_spark  # noqa: E402

HEADLINE = [
    "clean_sparse_columns",
    "fact_view",
    "fact_load_incremental",
    "audit_references",
    "audit_alignment",
    "audit_non_numeric",
    "key_dense",
    "dedupe_events",
    "star_by_year_country",
]


def _materialise(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", "dimloom-bench", **{"spark.sql.shuffle.partitions": cpus})
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        _materialise(catalog.QUERIES["fact_view"](spark, warm))

    times: dict[str, float] = {}
    pipeline.forget_staging()
    star.forget()
    t0 = time.perf_counter()
    pipeline.stage(spark, sf_dir)
    times["stage"] = time.perf_counter() - t0
    t0 = time.perf_counter()
    star.dimensions(spark, sf_dir, [lk.dim for lk in LOOKUPS] + ["DimRegion"])
    times["dimensions"] = time.perf_counter() - t0
    errors: dict[str, str] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        try:
            _materialise(catalog.QUERIES[name](spark, sf_dir))
            times[name] = time.perf_counter() - t0
        except Exception as e:  # noqa: BLE001 -- reported, and the JSON line still printed
            errors[name] = f"{type(e).__name__}: {e}"[:300]
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "pipeline_and_headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is materialised in full with Spark's ``noop`` sink (every row is
computed, nothing is collected to the driver), three times: the first (cold) run
includes code generation and JIT warm-up, which vanish at scale; the metric is
the sum of the better of two warm runs (the shared VM's speed drifts), and the
cold times are reported alongside. ``upsert_write`` runs the whole
incremental load: initial snapshot, then one run window merged into the touched
partitions with the stage-and-swap write. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lakeload.plans import fixtures as fx  # noqa: E402
from lakeload.plans.registry import QUERIES  # noqa: E402
from lakeload.plans.upsert import run_upsert, run_upsert_bucketed  # noqa: E402
from lakeload.session import get_session, scratch_dir  # noqa: E402
from lakeload.spec import TableSpec  # noqa: E402

HEADLINE = [
    "m1_merge_upsert",             # flagship: window -> latest per key -> merge
    "m4_update_values",            # merge with NULL keys / guards / keep-if-null
    "d1_latest_by_agg_composite",  # latest row per (order, line): aggregate form
    "d2_latest_by_window_composite",  # same input, window form
    "a7_audit_tables",             # audit counts, raw and snapshot
    "s1_scan_delimited_header2",   # landing: text with 2 header rows -> safe cast
    "p1_safe_cast_all",
    "j1_catalog_join",
    "w4_pending_windows",          # run-window planning over all jobs
    "n4_all_stats",                # nested statistics flattening
    "l1_resolve_layers",
    "k1_append_raw",
]


def materialise(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def upsert_write(spark, sf: str) -> None:
    orders = fx.read(spark, sf, "orders")
    spec = TableSpec(**{**fx.ORDERS_SPEC.__dict__, "partition_unit": "MONTH",
                        "partition_column": "o_orderdate_part"})
    path = scratch_dir(spark, "bench_snapshot")
    # initial load: everything before 1997-06, then one window on top
    run_upsert(spark, orders, path, spec, fx.ORDERS_LOAD, "19900101000000", "19970531235959")
    run_upsert(spark, orders, path, spec, fx.ORDERS_LOAD, fx.INC_START, fx.INC_END)
    spark.read.parquet(path).agg(F.count(F.lit(1))).collect()


def upsert_write_bucketed(spark, sf: str) -> None:
    import uuid
    orders = fx.read(spark, sf, "orders")
    spec = TableSpec(**{**fx.ORDERS_SPEC.__dict__, "partition_unit": "MONTH",
                        "partition_column": "o_orderdate_part", "buckets": 4})  # ~128 MB+ per bucket file at scale
    name = f"bench_snapshot_{uuid.uuid4().hex[:8]}"
    path = scratch_dir(spark, "bench_bucketed")
    run_upsert_bucketed(spark, orders, name, spec, fx.ORDERS_LOAD, "19900101000000", "19970531235959", path=path)
    run_upsert_bucketed(spark, orders, name, spec, fx.ORDERS_LOAD, fx.INC_START, fx.INC_END)
    spark.table(name).agg(F.count(F.lit(1))).collect()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", app_name="lakeload-bench", shuffle_partitions=max(8, 2 * cpus),
                        extra={"spark.driver.memory": "16g"})
    # warm-up: JVM, parquet footers, codegen caches
    materialise(QUERIES["a1_row_count"](spark, sf_dir))
    cold, warm = {}, {}
    runs = [(name, lambda n=name: materialise(QUERIES[n](spark, sf_dir))) for name in HEADLINE]
    runs.append(("upsert_write", lambda: upsert_write(spark, sf_dir)))
    runs.append(("upsert_write_bucketed", lambda: upsert_write_bucketed(spark, sf_dir)))
    for name, run in runs:
        times = []
        for _ in range(3):  # cold, then two warm runs; the better warm run is kept
            t0 = time.perf_counter()
            run()
            times.append(round(time.perf_counter() - t0, 3))
        cold[name], warm[name] = times[0], min(times[1:])
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_sec_warm", "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "cold_total": round(sum(cold.values()), 3), "cold": cold,
                      "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Print the physical plans of the headline queries (used to write PLANS.md).

    python tests/plans_report.py [sf_dir]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["d1_latest_by_agg_composite", "d2_latest_by_window",
         "a7_audit_tables", "s1_scan_delimited_header2", "j1_catalog_join", "w4_pending_windows",
         "l1_resolve_layers", "r1_retention_candidates"]


def upsert_plans(spark, sf_dir: str):
    """Plans of the second run window after an initial load, for a path snapshot
    and for a bucketed snapshot table (what run_upsert / run_upsert_bucketed execute)."""
    import uuid

    from lakeload.plans import fixtures as fx
    from lakeload.operators.merge import touched_partitions_frame
    from lakeload.plans.upsert import dry_run_upsert, run_upsert, run_upsert_bucketed, source_slice
    from lakeload.session import scratch_dir, written
    from lakeload.spec import TableSpec
    orders = fx.read(spark, sf_dir, "orders")
    spec = TableSpec(**{**fx.ORDERS_SPEC.__dict__, "partition_unit": "MONTH",
                        "partition_column": "o_orderdate_part"})
    path = scratch_dir(spark, "plans_snapshot")
    run_upsert(spark, orders, path, spec, fx.ORDERS_LOAD, "19900101000000", "19970531235959")
    touched = written(touched_partitions_frame(source_slice(orders, spec, fx.ORDERS_LOAD, fx.INC_START, fx.INC_END), spec), "touched")
    yield "run_upsert (parquet snapshot, second window)", dry_run_upsert(
        orders, spark.read.parquet(path), spec, fx.ORDERS_LOAD, fx.INC_START, fx.INC_END, touched=touched).plan
    bspec = TableSpec(**{**spec.__dict__, "buckets": 8})
    name = f"plans_bucketed_{uuid.uuid4().hex[:8]}"
    run_upsert_bucketed(spark, orders, name, bspec, fx.ORDERS_LOAD, "19900101000000", "19970531235959",
                        path=scratch_dir(spark, "plans_bucketed"))
    yield "run_upsert_bucketed (bucketed snapshot table, second window)", dry_run_upsert(
        orders, spark.table(name), bspec, fx.ORDERS_LOAD, fx.INC_START, fx.INC_END, touched=touched).plan


def main(sf_dir: str) -> None:
    from lakeload.plans.registry import QUERIES
    from lakeload.session import get_session
    spark = get_session("local[8]", shuffle_partitions=16)
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    plans = list(upsert_plans(spark, sf_dir))
    plans += [(name, QUERIES[name](spark, sf_dir)._jdf.queryExecution().explainString(mode)) for name in NAMES]
    for name, plan in plans:
        if "(1)" in plan:  # formatted plans: the tree, then each scan's filters
            tree = plan.split("\n\n")[0]
            blocks = re.findall(r"^\(\d+\) Scan parquet.*?(?=^\(\d+\) |\Z)", plan, flags=re.M | re.S)
            keep = ("Location", "PartitionFilters", "PushedFilters", "Bucketed", "SelectedBucketsCount")
            plan = tree + "\n" + "\n".join(
                "\n".join([b.splitlines()[0]] + [ln for ln in b.splitlines() if ln.startswith(keep)]) for b in blocks)
        plan = re.sub(r"#\d+L?", "", plan)                       # expression ids
        plan = re.sub(r"file:[^\],]*/", "…/", plan)               # local paths
        plan = re.sub(r"\[plan_id=\d+\]", "", plan)
        lines = [ln if ("Scan" in ln or "Filters" in ln) else ln[:170]
                 for ln in plan.splitlines() if ln.strip() and not ln.startswith("==")]
        print(f"### {name}\n\n```\n" + "\n".join(lines) + "\n```\n")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")

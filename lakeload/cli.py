"""Command-line jobs (``spark-submit --py-files lakeload.zip submit.py <command> ...`` on a cluster,
``python -m lakeload.cli <command> ...`` locally).

    copy    connector read -> connector write (K8), optional check_data preview
    upsert  one run window of a raw table merged into its snapshot (table keys JSON
            in the reference's config layout: PRIMARY_KEYS, ORDERING_COLUMNS, DATA, ...)
    land    delimited files -> raw table (schema JSON: {"schema": [{name, dataType}]})
    audit   raw / snapshot count report of catalog tables (<t>_raw and <t>)

The session comes from the cluster (no master is set here), and so does
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import sys

from .session import get_session
from .spec import LoadSpec, TableSpec


def _json(text: str):
    """Inline JSON, or ``@path`` to a JSON file."""
    if text.startswith("@"):
        with open(text[1:]) as f:
            return json.load(f)
    return json.loads(text)


def _flag(text: str) -> bool:
    return str(text).strip().capitalize() == "True"


def cmd_copy(a) -> None:
    from .sinks.tables import copy_table
    spark = get_session(app_name="lakeload-copy")
    count = copy_table(spark, a.source_format, _json(a.source_options), a.sink_format, _json(a.sink_options),
                       mode="append" if _flag(a.append_mode) else "overwrite", check_data=_flag(a.check_data),
                       query=a.source_query or None)
    if count is not None:
        print(json.dumps({"rows": count}))


def cmd_upsert(a) -> None:
    from .plans.upsert import dry_run_upsert, run_upsert, run_upsert_bucketed
    spark = get_session(app_name="lakeload-upsert")
    keys = _json(a.table_keys)
    common = _json(a.common) if a.common else {}
    spec = TableSpec.from_config(keys, common, casts=_json(a.casts) if a.casts else None, query_type=a.query_type)
    spec = TableSpec(**{**spec.__dict__, "partition_column": a.partition_column or (f"{spec.partition_field}_part"
                                                                   if spec.partition_field else None),
                        "buckets": a.buckets or None, "rewrite": a.rewrite})
    load = LoadSpec(audit_column=common.get("AUDIT_COLUMNS", "last_ingestion_utc_time"), zone=a.zone,
                    raw_partition_column=a.raw_partition_column or None, raw_partition_unit=a.raw_partition_unit)
    raw = spark.table(a.raw) if not a.raw.startswith(("/", "file:", "s3a:", "gs:", "hdfs:")) \
        else spark.read.parquet(a.raw)
    if a.dry_run:
        target = spark.table(a.snapshot) if spec.buckets else spark.read.parquet(a.snapshot)
        print(dry_run_upsert(raw, target, spec, load, a.start_run_id, a.end_run_id,
                             whole_table=a.whole_table).plan)
        return
    if spec.buckets:
        res = run_upsert_bucketed(spark, raw, a.snapshot, spec, load, a.start_run_id, a.end_run_id,
                                  path=a.path, whole_table=a.whole_table)
    else:
        res = run_upsert(spark, raw, a.snapshot, spec, load, a.start_run_id, a.end_run_id,
                         whole_table=a.whole_table)
    print(json.dumps({"partitions": res.partitions, "rewritten_partitions": res.rewritten_partitions, "path": res.path,
                      "rewritten_files": len(res.files), "inserted": res.inserted}))


def cmd_land(a) -> None:
    from .plans.landing import land_delimited
    spark = get_session(app_name="lakeload-land")
    land_delimited(spark, a.source, a.raw_path, _json(a.schema), a.delimiter, a.header_rows,
                   audit_exprs=[e for e in (a.audit or "").split(";") if e.strip()],
                   source_timezone=a.zone, partition_field=a.partition_field, partition_unit=a.partition_unit,
                   cluster=a.cluster)


def cmd_audit(a) -> None:
    from .operators.audit import audit_catalog_tables
    spark = get_session(app_name="lakeload-audit")
    keys = _json(a.keys)  # {"table": "k1,k2", ...}
    tables = [(t, [k.strip() for k in str(v).split(",") if k.strip()]) for t, v in keys.items()]
    report = audit_catalog_tables(spark, tables, a.database)
    for row in report.toLocalIterator():  # one row per table
        print(json.dumps(row.asDict(), default=str))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakeload")
    sub = p.add_subparsers(dest="command", required=True)

    c = sub.add_parser("copy")
    c.add_argument("--source_format", required=True)
    c.add_argument("--source_options", default="{}")
    c.add_argument("--source_query", default="")
    c.add_argument("--sink_format", required=True)
    c.add_argument("--sink_options", default="{}")
    c.add_argument("--check_data", default="False")
    c.add_argument("--append_mode", default="False")
    c.set_defaults(func=cmd_copy)

    u = sub.add_parser("upsert")
    u.add_argument("--raw", required=True, help="raw table name or parquet path")
    u.add_argument("--snapshot", required=True, help="snapshot parquet path (or table name with --buckets)")
    u.add_argument("--table_keys", required=True, help="JSON or @file: PRIMARY_KEYS, ORDERING_COLUMNS, DATA, ...")
    u.add_argument("--common", default="", help="JSON or @file: COMMON_CONFIG.DATA")
    u.add_argument("--casts", default="")
    u.add_argument("--start_run_id")
    u.add_argument("--end_run_id")
    u.add_argument("--whole_table", action="store_true")
    u.add_argument("--query_type", default="ARRAY_AGG", help="ARRAY_AGG (default) or ROW_NUM")
    u.add_argument("--partition_column", default="")
    u.add_argument("--buckets", type=int, default=0)
    u.add_argument("--path", default=None, help="location of a new bucketed snapshot table")
    u.add_argument("--rewrite", default="partitions", choices=("partitions", "files"), help="what the merge rewrites of a path snapshot")
    u.add_argument("--zone", default="PST8PDT")
    u.add_argument("--raw_partition_column", default="", help="raw folder key derived from the audit column")
    u.add_argument("--raw_partition_unit", default="DAY")
    u.add_argument("--dry_run", action="store_true")
    u.set_defaults(func=cmd_upsert)

    ld = sub.add_parser("land")
    ld.add_argument("--source", required=True)
    ld.add_argument("--raw_path", required=True)
    ld.add_argument("--schema", required=True)
    ld.add_argument("--delimiter", default="|")
    ld.add_argument("--header_rows", type=int, default=0)
    ld.add_argument("--audit", default="", help="audit expressions separated by ';'")
    ld.add_argument("--zone", default="PST8PDT")
    ld.add_argument("--partition_field")
    ld.add_argument("--partition_unit")
    ld.add_argument("--cluster")
    ld.set_defaults(func=cmd_land)

    au = sub.add_parser("audit")
    au.add_argument("--keys", required=True, help='JSON or @file: {"table": "key1,key2"}')
    au.add_argument("--database")
    au.set_defaults(func=cmd_audit)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.func(args)


if __name__ == "__main__":
    main(sys.argv[1:])

"""
DuckDB SQL that must give the same rows (omitted for rows-only checks).

Every query reads the given tables (or frames Spark derives from them) in full;
none filters rows to keep the check cheap.
"""

from __future__ import annotations

import os
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..session import scratch_dir, table_path
from ..sinks import tables as sinks
from ..sources import connectors, files, inventory, warehouse
from ..operators import audit, dedup, jobstats, joins, layers, merge, project, retention, windows
from ..spec import TableSpec
from . import fixtures as fx
from .upsert import incremental_merge, source_slice

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


# ---------------------------------------------------------------- SQL helpers

def bound(run_id: str, zone: str = "PST8PDT") -> str:
    """DuckDB: run id read in ``zone`` -> UTC wall clock."""
    return f"timezone('UTC', timezone('{zone}', strptime('{run_id}', '%Y%m%d%H%M%S')))"


def crc32_sql(text: str, name: str = "crcs") -> str:
    """DuckDB: CTEs ``name`` (text, crc) of the texts that the query ``text`` gives as ``text``: a byte-wise fold over a
    table of 256 remainders, itself eight bit-wise steps of the polynomial 0xEDB88320."""
    return f"""{name}_table AS (SELECT [list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
  FOR i IN range(256)] AS tab),
{name}_bytes AS (SELECT DISTINCT text, [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(text)), '..')] AS bytes FROM ({text})),
{name} AS (SELECT text, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS crc
  FROM {name}_bytes, {name}_table)"""


ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
INC_WINDOW = f"o_orderdate BETWEEN {bound(fx.INC_START)} AND {bound(fx.INC_END)}"


def latest_sql(src: str, keys: str, order: str, cols: str) -> str:
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY "
            + ", ".join(f"{c.strip()} DESC NULLS LAST" for c in order.split(","))
            + f") AS rn__ FROM {src}) WHERE rn__ = 1")


ORDERS_NULLS_SQL = """(SELECT o_orderkey,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
    o_orderstatus,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
    o_orderpriority FROM orders)"""

SNAP_CTE = "snap AS (" + latest_sql(
    "(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')",
    "o_custkey", "o_orderdate, o_orderkey", ORDER_COLS) + ")"


def merge_sql(target_cte: str, slice_src: str, guard: str, update: dict[str, str],
              insert: dict[str, str], scope: str) -> str:
    """MERGE emulated with NOT EXISTS / inner join branches (independent of the Spark plan)."""
    upd = ", ".join(f"CASE WHEN {guard} THEN {update[c]} ELSE t.{c} END AS {c}" for c in update)
    ins = ", ".join(f"{insert[c]} AS {c}" for c in insert)
    return f"""
WITH {target_cte},
sl AS (SELECT * FROM {slice_src}),
src AS ({latest_sql('sl', 'o_custkey', 'o_orderdate, o_orderkey', ORDER_COLS)}),
touched AS (SELECT DISTINCT {scope.format(x='o_orderdate')} AS p FROM sl),
tin AS (SELECT * FROM snap WHERE date_trunc('year', o_orderdate) IN (SELECT p FROM touched)
        {{null_scope}}),
trest AS (SELECT * FROM snap EXCEPT ALL SELECT * FROM tin)
SELECT * FROM trest
UNION ALL SELECT t.* FROM tin t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.o_custkey = t.o_custkey)
UNION ALL SELECT {upd} FROM tin t JOIN src s ON s.o_custkey = t.o_custkey
UNION ALL SELECT {ins} FROM src s WHERE NOT EXISTS (SELECT 1 FROM tin t WHERE t.o_custkey = s.o_custkey)
"""


ALL_UPDATE = {c.strip(): f"s.{c.strip()}" for c in ORDER_COLS.split(",")}
ALL_INSERT = dict(ALL_UPDATE)
DEFAULT_GUARD = "(s.o_orderdate IS NOT NULL AND t.o_orderdate <= s.o_orderdate)"
YEAR_SCOPE = "date_trunc('year', {x})"
YEAR_SCOPE_NULL = "date_trunc('year', coalesce({x}, TIMESTAMP '1970-01-01'))"


# ---------------------------------------------------------------- D1, D2, P6

@register("p6_filter_window", f"SELECT {ORDER_COLS} FROM orders WHERE {INC_WINDOW}")
def p6_filter_window(spark, sf):
    return project.filter_window(fx.read(spark, sf, "orders"), "o_orderdate", fx.INC_START, fx.INC_END)


@register("d1_latest_by_agg", latest_sql("orders", "o_custkey", "o_orderdate, o_orderkey", ORDER_COLS))
def d1_latest_by_agg(spark, sf):
    return dedup.latest_by_agg(fx.read(spark, sf, "orders"), fx.ORDERS_KEYS, fx.ORDERS_ORDER)


LINE_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
             "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")


@register("d1_latest_by_agg_composite", latest_sql(
    "lineitem", "l_orderkey, l_linenumber", "l_shipdate, l_partkey, l_suppkey", LINE_COLS))
def d1_latest_by_agg_composite(spark, sf):
    return dedup.latest_by_agg(fx.read(spark, sf, "lineitem"), fx.LINE_KEYS, fx.LINE_ORDER)


@register("d1_latest_by_agg_nulls", latest_sql(
    ORDERS_NULLS_SQL, "o_custkey", "o_orderdate, o_orderkey", ORDER_COLS))
def d1_latest_by_agg_nulls(spark, sf):
    return dedup.latest_by_agg(fx.orders_with_nulls(fx.read(spark, sf, "orders")), fx.ORDERS_KEYS, fx.ORDERS_ORDER)


@register("d2_latest_by_window", """
SELECT * FROM (SELECT event_id, ts, user_id, event_type, value, props,
  CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST)
    AS INTEGER) AS RNK
  FROM events) WHERE RNK = 1""")
def d2_latest_by_window(spark, sf):
    return dedup.latest_by_window(fx.read(spark, sf, "events"), fx.EVENT_KEYS, fx.EVENT_ORDER)


# ---------------------------------------------------------------- M1-M8

@register("m1_merge_upsert", merge_sql(SNAP_CTE, f"orders WHERE {INC_WINDOW}", DEFAULT_GUARD,
                                       ALL_UPDATE, ALL_INSERT, YEAR_SCOPE).replace("{null_scope}", ""))
def m1_merge_upsert(spark, sf):
    orders = fx.read(spark, sf, "orders")
    return incremental_merge(orders, fx.orders_snapshot(orders), fx.ORDERS_SPEC, fx.ORDERS_LOAD,
                             fx.INC_START, fx.INC_END)


@register("m2_guard_explicit", merge_sql(
    SNAP_CTE, f"orders WHERE {INC_WINDOW}", "coalesce(t.o_totalprice < s.o_totalprice, false)",
    ALL_UPDATE, ALL_INSERT, YEAR_SCOPE).replace("{null_scope}", ""))
def m2_guard_explicit(spark, sf):
    orders = fx.read(spark, sf, "orders")
    spec = TableSpec(**{**fx.ORDERS_SPEC.__dict__, "matched": "o_totalprice"})
    return incremental_merge(orders, fx.orders_snapshot(orders), spec, fx.ORDERS_LOAD, fx.INC_START, fx.INC_END)


NULL_SNAP_CTE = "snap AS (" + latest_sql(
    f"(SELECT * FROM {ORDERS_NULLS_SQL} WHERE o_orderdate < TIMESTAMP '1998-01-01' OR o_orderdate IS NULL)",
    "o_custkey", "o_orderdate, o_orderkey", ORDER_COLS) + ")"
NULL_SLICE = (f"{ORDERS_NULLS_SQL} WHERE o_orderdate BETWEEN {bound(fx.INC_START)} AND {bound(fx.INC_END)}"
              f" OR o_orderdate IS NULL")


def _null_spec(**kw) -> TableSpec:
    base = dict(fx.ORDERS_SPEC.__dict__)
    base.update(null_partition="allow", inner_where=None)
    base.update(kw)
    return TableSpec(**base)


def _null_merge(spark, sf, spec, columns=None):
    o = fx.orders_with_nulls(fx.read(spark, sf, "orders"))
    snap = dedup.latest_by_agg(o.where((F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
                                       | F.col("o_orderdate").isNull()), fx.ORDERS_KEYS, fx.ORDERS_ORDER)
    lo, hi = project.window_bounds(o, "o_orderdate", fx.INC_START, fx.INC_END)
    sl = o.where(F.col("o_orderdate").between(lo, hi) | F.col("o_orderdate").isNull())
    src = dedup.latest_by_agg(sl, spec.primary_keys, spec.ordering)
    return merge.merge_upsert(snap, src, spec, columns=columns, source_slice=sl)


@register("m3_guard_default", merge_sql(
    NULL_SNAP_CTE, NULL_SLICE, DEFAULT_GUARD, ALL_UPDATE, ALL_INSERT, YEAR_SCOPE_NULL)
    .replace("{null_scope}", "OR o_orderdate IS NULL"))
def m3_guard_default(spark, sf):
    return _null_merge(spark, sf, _null_spec())


M4_UPDATE = dict(ALL_UPDATE, o_totalprice="coalesce(s.o_totalprice, t.o_totalprice)",
                 o_orderpriority="t.o_orderpriority")


@register("m4_update_values", merge_sql(
    NULL_SNAP_CTE, NULL_SLICE, DEFAULT_GUARD, M4_UPDATE, ALL_INSERT, YEAR_SCOPE_NULL)
    .replace("{null_scope}", "OR o_orderdate IS NULL"))
def m4_update_values(spark, sf):
    return _null_merge(spark, sf, _null_spec(keep_if_null=("o_totalprice",), never_update=("o_orderpriority",)))


M5_COLS = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
M5_UPDATE = {c: (f"s.{c}" if c in M5_COLS else f"t.{c}") for c in ALL_UPDATE}
M5_INSERT = {c: (f"s.{c}" if c in M5_COLS else
                 ("CAST(NULL AS VARCHAR)" if c in ("o_orderstatus", "o_orderpriority") else "NULL"))
             for c in ALL_UPDATE}


@register("m5_insert_values", merge_sql(
    NULL_SNAP_CTE, NULL_SLICE, DEFAULT_GUARD, M5_UPDATE, M5_INSERT, YEAR_SCOPE_NULL)
    .replace("{null_scope}", "OR o_orderdate IS NULL"))
def m5_insert_values(spark, sf):
    return _null_merge(spark, sf, _null_spec(), columns=list(M5_COLS))


@register("m6_scope_partitions", f"""
WITH {NULL_SNAP_CTE}, sl AS (SELECT * FROM {NULL_SLICE}),
touched AS (SELECT DISTINCT date_trunc('year', coalesce(o_orderdate, TIMESTAMP '1970-01-01')) AS p FROM sl)
SELECT * FROM snap WHERE date_trunc('year', o_orderdate) IN (SELECT p FROM touched) OR o_orderdate IS NULL""")
def m6_scope_partitions(spark, sf):
    o = fx.orders_with_nulls(fx.read(spark, sf, "orders"))
    snap = dedup.latest_by_agg(o.where((F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
                                       | F.col("o_orderdate").isNull()), fx.ORDERS_KEYS, fx.ORDERS_ORDER)
    lo, hi = project.window_bounds(o, "o_orderdate", fx.INC_START, fx.INC_END)
    sl = o.where(F.col("o_orderdate").between(lo, hi) | F.col("o_orderdate").isNull())
    spec = _null_spec()
    inside, _ = merge.split_scope(snap, spec, merge.touched_partitions_frame(sl, spec))
    return inside


@register("m7_touched_partitions", f"""
SELECT DISTINCT date_trunc('month', o_orderdate) AS partition_key FROM orders WHERE {INC_WINDOW}""")
def m7_touched_partitions(spark, sf):
    spec = TableSpec(**{**fx.ORDERS_SPEC.__dict__, "partition_unit": "MONTH"})
    sl = source_slice(fx.read(spark, sf, "orders"), spec, fx.ORDERS_LOAD, fx.INC_START, fx.INC_END)
    return merge.touched_partitions_frame(sl, spec)


@register("m7_touched_partitions_nulls", f"""
SELECT DISTINCT date_trunc('year', coalesce(o_orderdate, TIMESTAMP '1970-01-01')) AS partition_key
FROM {NULL_SLICE}""")
def m7_touched_partitions_nulls(spark, sf):
    o = fx.orders_with_nulls(fx.read(spark, sf, "orders"))
    lo, hi = project.window_bounds(o, "o_orderdate", fx.INC_START, fx.INC_END)
    sl = o.where(F.col("o_orderdate").between(lo, hi) | F.col("o_orderdate").isNull())
    return merge.touched_partitions_frame(sl, _null_spec())


@register("m8_check_partition_nulls", f"SELECT {ORDER_COLS} FROM orders WHERE {INC_WINDOW}")
def m8_check_partition_nulls(spark, sf):
    sl = project.filter_window(fx.read(spark, sf, "orders"), "o_orderdate", fx.INC_START, fx.INC_END)
    return merge.check_partition_nulls(sl, fx.ORDERS_SPEC)


@register("m8_null_partition_raises", f"""SELECT 'partition column o_orderdate has NULL values in the source slice' AS error
FROM {ORDERS_NULLS_SQL} WHERE o_orderdate IS NULL HAVING count(*) > 0""")
def m8_null_partition_raises(spark, sf):
    """The text that a slice with NULL partition values fails with."""
    o = fx.orders_with_nulls(fx.read(spark, sf, "orders"))
    try:
        merge.check_partition_nulls(o, fx.ORDERS_SPEC).write.format("noop").mode("overwrite").save()
        said = []
    except Exception as e:  # noqa: BLE001
        said = [m[0] for m in [re.search("partition column .* source slice", str(e))] if m]
    return spark.createDataFrame([(x,) for x in said], "error string")


# ---------------------------------------------------------------- A1-A7

@register("a1_row_count", "SELECT count(*) AS records_count FROM lineitem")
def a1_row_count(spark, sf):
    return audit.row_count(fx.read(spark, sf, "lineitem"))


@register("a2_count_where", """
SELECT count(*) AS records_count FROM orders WHERE o_orderdate = TIMESTAMP '1997-01-01 00:00:00'""")
def a2_count_where(spark, sf):
    return audit.count_where(fx.read(spark, sf, "orders"),
                             F.col("o_orderdate") == F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"))


@register("a3_distinct_key_count", """
SELECT count(*) AS records_count FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""")
def a3_distinct_key_count(spark, sf):
    return audit.distinct_key_count(fx.read(spark, sf, "lineitem"), fx.LINE_KEYS)


@register("a3_distinct_key_count_nulls", f"""
SELECT count(*) AS records_count FROM (SELECT DISTINCT o_custkey, o_orderdate FROM {ORDERS_NULLS_SQL})""")
def a3_distinct_key_count_nulls(spark, sf):
    return audit.distinct_key_count(fx.orders_with_nulls(fx.read(spark, sf, "orders")), ["o_custkey", "o_orderdate"])


@register("a4_null_key_count", f"""
SELECT count(*) AS records_count FROM {ORDERS_NULLS_SQL} WHERE o_custkey IS NULL AND o_orderdate IS NULL""")
def a4_null_key_count(spark, sf):
    return audit.null_key_count(fx.orders_with_nulls(fx.read(spark, sf, "orders")), ["o_custkey", "o_orderdate"])


@register("a1_a2_a4_of_loads", f"""WITH {SNAP_CTE},
r AS (SELECT count(*) AS n, count(*) FILTER (o_custkey % 7 = 0) AS z, count(*) FILTER (o_orderstatus = 'F') AS h FROM orders),
s AS (SELECT count(DISTINCT o_custkey) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' OR {INC_WINDOW})
SELECT 'raw' AS side, n AS total_count, z AS primary_key_null_count, h AS history_count FROM r
UNION ALL SELECT 'snapshot', n, 0, 0 FROM s""")
def a1_a2_a4_of_loads(spark, sf):
    """The audit counts of two appends and of two upserts, taken by the jobs that wrote them."""
    o = fx.read(spark, sf, "orders")
    marked = o.withColumn("o_custkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey"))).withColumn(
        audit.HISTORY_COLUMN, F.when(F.col("o_orderstatus") == "F", F.lit(audit.HISTORY_MARKER)).otherwise("2023-01-01 00:00:00").cast("timestamp_ntz"))
    raw = scratch_dir(spark, "a1_raw")
    for part in (F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 2 == 1):
        sinks.append_raw(marked.where(part), raw, "o_orderdate", "MONTH", audit_keys=["o_custkey"])
    spec = TableSpec(**{**fx.ORDERS_SPEC.__dict__, "partition_field": None, "partition_column": None})
    path = _snapshot_path(spark, sf, spec)
    return (audit.audit_of_loads(spark, raw).withColumn("side", F.lit("raw"))
            .unionByName(audit.audit_of_loads(spark, path).withColumn("side", F.lit("snapshot"))))


@register("a5_scalar", "SELECT CAST(max(o_totalprice) AS VARCHAR) AS max_price FROM orders")
def a5_scalar(spark, sf):
    agg = fx.read(spark, sf, "orders").agg(F.max("o_totalprice").alias("max_price"))
    return audit.scalar(agg, "max_price")


@register("a5_scalar_empty", "SELECT '0' AS max_price")
def a5_scalar_empty(spark, sf):
    agg = fx.read(spark, sf, "orders").groupBy("o_orderstatus").agg(F.max("o_totalprice").alias("max_price"))
    return audit.scalar(agg.where(F.col("o_orderstatus") == "no such status"), "max_price")


@register("a6_distinct_projection", "SELECT DISTINCT o_custkey FROM orders")
def a6_distinct_projection(spark, sf):
    return audit.distinct_projection(fx.read(spark, sf, "orders"), ["o_custkey"])


A7_CTES = f"""WITH raw AS (SELECT * FROM orders),
{SNAP_CTE},
lraw AS (SELECT * FROM lineitem)"""

A7_ORDERS_COUNTS = """
  (SELECT count(*) FROM raw) AS raw_total_count,
  (SELECT count(*) FROM raw WHERE o_orderdate = TIMESTAMP '1997-01-01 00:00:00') AS raw_history_count,
  (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM raw)) AS raw_distinct_primary_key_count,
  (SELECT count(*) FROM raw WHERE o_custkey IS NULL) AS raw_primary_key_null_count,
  (SELECT count(*) FROM snap) AS snapshot_total_count,
  (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM snap)) AS snapshot_distinct_primary_key_count,
  (SELECT count(*) FROM snap WHERE o_custkey IS NULL) AS snapshot_primary_key_null_count,
  'RAW_AND_SNAPSHOT' AS table_type,
  (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM raw)) = (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM snap))
    AS raw_distinct_equals_snapshot_distinct,
  (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM raw)) = (SELECT count(*) FROM snap)
    AS raw_distinct_equals_snapshot_total"""

A7_ORACLE = f"""{A7_CTES}
SELECT 'orders' AS table_name,{A7_ORDERS_COUNTS}
UNION ALL
SELECT 'lineitem', (SELECT count(*) FROM lraw), 0,
  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lraw)),
  (SELECT count(*) FROM lraw WHERE l_orderkey IS NULL AND l_linenumber IS NULL),
  0, 0, 0, 'RAW_ONLY',
  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lraw)) = 0,
  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lraw)) = 0
"""


@register("a7_audit_tables", A7_ORACLE)
def a7_audit_tables(spark, sf):
    orders = fx.read(spark, sf, "orders")
    hist = F.col("o_orderdate") == F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
    return audit.audit_tables([
        audit.AuditTable("orders", orders, fx.orders_snapshot(orders), fx.ORDERS_KEYS, hist),
        audit.AuditTable("lineitem", fx.read(spark, sf, "lineitem"), None, fx.LINE_KEYS),
    ])


# ---------------------------------------------------------------- J1-J5

CATALOG_SQL = """
jobs AS (SELECT c_custkey AS job_key, c_name AS job_name, c_nationkey AS application_system_key,
    c_nationkey % 5 AS logic_module_key,
    CASE WHEN c_custkey % 3 = 0 THEN 15 ELSE 30 END AS job_frequency_code,
    CASE WHEN c_acctbal >= 0 THEN 'Y' ELSE 'N' END AS is_active,
    CASE WHEN c_custkey % 17 = 0 THEN 'Y' ELSE 'N' END AS is_skip,
    CASE WHEN c_custkey % 19 = 0 THEN 'Y' ELSE 'N' END AS is_hold,
    c_mktsegment AS scheduler_chain_name, lower(c_name) AS scheduler_job_name,
    '{"catch_up": "' || CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END
      || '", "owner": {"id": ' || CAST(c_custkey AS VARCHAR) || '}}' AS job_attributes
  FROM customer),
deps AS (SELECT o_custkey AS job_key, o_orderkey AS related_job_key,
    CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS is_active FROM orders),
details AS (SELECT c_custkey AS job_key, c_custkey * 10 AS data_entity_key,
    c_nationkey AS source_application_server_key, (c_nationkey + 1) % 25 AS target_application_server_key
  FROM customer),
servers AS (SELECT n_nationkey AS application_server_key, '{"server": "' || n_name || '"}' AS server_attributes,
    CASE WHEN n_nationkey % 10 = 3 THEN 'N' ELSE 'Y' END AS is_active FROM nation),
logic AS (SELECT r_regionkey AS logic_module_key,
    CASE WHEN r_regionkey % 2 = 0 THEN 'spark' ELSE 'script' END AS logic_module_type_code,
    '{"runtime_in_ms_enabled": "' || CASE WHEN r_regionkey = 1 THEN 'false' ELSE 'true' END || '"}' AS logic_body
  FROM region),
systems AS (SELECT n_nationkey AS application_system_key,
    '{"region": ' || CAST(n_regionkey AS VARCHAR) || '}' AS system_attributes,
    CASE WHEN n_regionkey = 4 THEN 'N' ELSE 'Y' END AS is_active FROM nation)"""


def catalog_frames(spark, sf):
    customer = fx.read(spark, sf, "customer")
    nation = fx.read(spark, sf, "nation")
    return dict(jobs=fx.jobs(customer), dependency=fx.dependencies(fx.read(spark, sf, "orders")),
                details=fx.details(customer), servers=fx.servers(nation),
                logic=fx.logic_modules(fx.read(spark, sf, "region")), systems=fx.systems(nation))


# the rule in parts: a job with dependencies keeps those that are active or unflagged, one
# without any keeps a row with none; then details with both servers, module and system
J1_SQL = f"""
WITH {CATALOG_SQL},
chain AS (SELECT * FROM jobs WHERE is_active = 'Y' AND scheduler_chain_name = '{fx.CHAIN}'),
tied AS (
  SELECT job_key, related_job_key, is_active AS dependency_is_active FROM deps WHERE coalesce(is_active, 'Y') = 'Y'
  UNION ALL
  SELECT job_key, NULL, NULL FROM chain WHERE job_key NOT IN (SELECT job_key FROM deps)),
placed AS (
  SELECT d.job_key, d.data_entity_key, d.source_application_server_key, d.target_application_server_key,
    s.server_attributes AS source_server_attributes, t.server_attributes AS target_server_attributes
  FROM details d, servers s, servers t
  WHERE s.application_server_key = d.source_application_server_key
    AND t.application_server_key = d.target_application_server_key)
SELECT job_key, application_system_key, job_name, scheduler_job_name, job_attributes, job_frequency_code,
  chain.is_active AS job_is_active, dependency_is_active, related_job_key, data_entity_key,
  source_application_server_key, source_server_attributes, target_application_server_key, target_server_attributes,
  logic_module_type_code AS job_type, logic_body AS logic_attributes, system_attributes
FROM chain JOIN tied USING (job_key) JOIN placed USING (job_key)
  JOIN logic USING (logic_module_key) JOIN systems USING (application_system_key)
"""


@register("j1_catalog_join", J1_SQL)
def j1_catalog_join(spark, sf):
    return joins.catalog_join(**catalog_frames(spark, sf), chain_name=fx.CHAIN)


@register("j2_exclude_listed", f"""
SELECT {ORDER_COLS} FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def j2_exclude_listed(spark, sf):
    return joins.exclude_listed(fx.read(spark, sf, "orders"), fx.read(spark, sf, "lineitem"), "o_orderkey",
                                "l_orderkey")


@register("j2_exclude_flagged", f"WITH {CATALOG_SQL} SELECT * FROM jobs WHERE is_skip <> 'Y' AND is_hold <> 'Y'")
def j2_exclude_flagged(spark, sf):
    return joins.exclude_flagged(fx.jobs(fx.read(spark, sf, "customer")), ["is_skip", "is_hold"])


RUNS_SQL = """runs AS (SELECT user_id AS job_key, epoch_us(ts) // 1000 AS job_runtime_ms,
  CASE WHEN event_type = 'purchase' THEN 'COMMITTED' WHEN event_type = 'error' THEN 'FAILED'
       ELSE upper(event_type) END AS job_status_code, event_id AS job_run_sequence FROM events)"""


@register("j3_without_committed_run", f"""
WITH {RUNS_SQL}, req AS (SELECT user_id AS job_key, epoch_us(date_trunc('minute', ts)) // 1000 AS job_runtime_ms, event_id FROM events
  UNION ALL SELECT job_key, job_runtime_ms, job_run_sequence FROM runs)
SELECT * FROM req r WHERE NOT EXISTS (SELECT 1 FROM runs x WHERE x.job_status_code = 'COMMITTED'
  AND x.job_key = r.job_key AND x.job_runtime_ms = r.job_runtime_ms)""")
def j3_without_committed_run(spark, sf):
    events = fx.read(spark, sf, "events")
    runs = fx.run_stats(events)
    req = events.select(F.col("user_id").alias("job_key"),
                        fx.epoch_ms(F.date_trunc("MINUTE", "ts").cast("timestamp_ntz")).alias("job_runtime_ms"),
                        "event_id").unionByName(
        runs.select("job_key", "job_runtime_ms", F.col("job_run_sequence").alias("event_id")))
    return joins.without_committed_run(req, runs)


@register("j4_roots", f"""
WITH {CATALOG_SQL}
SELECT * FROM jobs j WHERE NOT EXISTS (SELECT 1 FROM deps d WHERE d.job_key = j.job_key
  AND d.related_job_key IS NOT NULL AND d.is_active = 'Y')""")
def j4_roots(spark, sf):
    return joins.roots(fx.jobs(fx.read(spark, sf, "customer")), fx.dependencies(fx.read(spark, sf, "orders")),
                       active_col="is_active")


@register("j5_held_entities", f"""
WITH {CATALOG_SQL}, jd AS (SELECT j.job_key, j.job_name, j.application_system_key, d.source_application_server_key,
  d.target_application_server_key FROM jobs j JOIN details d ON j.job_key = d.job_key)
SELECT * FROM jd WHERE application_system_key IN (SELECT application_system_key FROM systems WHERE is_active = 'N')
  OR source_application_server_key IN (SELECT application_server_key FROM servers WHERE is_active = 'N')
  OR target_application_server_key IN (SELECT application_server_key FROM servers WHERE is_active = 'N')""")
def j5_held_entities(spark, sf):
    c = catalog_frames(spark, sf)
    jd = c["jobs"].join(c["details"], "job_key").select(
        "job_key", "job_name", "application_system_key", "source_application_server_key",
        "target_application_server_key")
    return joins.held_entities(jd, c["systems"], c["servers"])


# ---------------------------------------------------------------- P1-P13

TEXT_ORDERS_TYPED = """SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders"""


@register("p1_safe_cast_all", TEXT_ORDERS_TYPED)
def p1_safe_cast_all(spark, sf):
    return project.safe_cast_all(fx.orders_as_text(fx.read(spark, sf, "orders")), fx.ORDERS_SCHEMA_JSON)


@register("p1_safe_cast_json", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice FROM orders""")
def p1_safe_cast_json(spark, sf):
    o = fx.read(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"),
                                            F.col("o_totalprice").cast("string").alias("o_totalprice"))
    schema = [("o_orderkey", "STRING"), ("o_totalprice", "FLOAT64")]
    return project.safe_cast_all(o, schema, null_marker=False, only_non_text=True)


@register("p2_null_literal", """SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def p2_null_literal(spark, sf):
    t = fx.orders_as_text(fx.read(spark, sf, "orders")).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus", "o_orderpriority")
    return project.null_literal(t, ["o_orderstatus", "o_orderpriority"])


@register("p3_clean_names", """SELECT o_orderkey AS order_key, o_custkey AS "customer_key",
  o_orderstatus AS "order_status_code" FROM orders""")
def p3_clean_names(spark, sf):
    o = fx.read(spark, sf, "orders").select(F.col("o_orderkey").alias("order key"),
                                            F.col("o_custkey").alias("customer key"),
                                            F.col("o_orderstatus").alias("order status code"))
    return project.clean_names(o)


@register("p4_add_audit_columns", """SELECT event_id, ts, user_id, event_type, value, props,
  date_trunc('day', ts) AS last_ingestion_utc_time, CAST(ts AS DATE) AS event_date,
  upper(event_type) AS event_kind, 'PST8PDT' AS source_timezone FROM events""")
def p4_add_audit_columns(spark, sf):
    e = fx.read(spark, sf, "events").withColumn(
        "last_ingestion_utc_time", F.date_trunc("DAY", "ts").cast("timestamp_ntz"))
    return project.add_audit_columns(e, ["CAST(ts AS DATE) AS event_date", "upper(event_type) AS event_kind"],
                                     "PST8PDT")


@register("p4_add_audit_columns_json", """SELECT event_id, ts, 'PST8PDT' AS source_timezone,
  date_trunc('day', ts) AS last_ingestion_utc_time FROM events""")
def p4_add_audit_columns_json(spark, sf):
    e = fx.read(spark, sf, "events").select(
        "event_id", "ts", F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("last_ingestion_utc_time"))
    return project.add_audit_columns(e, [], "PST8PDT", layout="json")


@register("p5_strict_cast", """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  CAST(o_totalprice AS DECIMAL(38,9)) AS o_totalprice FROM orders""")
def p5_strict_cast(spark, sf):
    o = fx.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return project.strict_cast(o, {"o_custkey": "STRING", "o_totalprice": "NUMERIC"})


@register("p7_filter_extra", f"SELECT {ORDER_COLS} FROM orders WHERE o_orderstatus = 'F' AND {INC_WINDOW}")
def p7_filter_extra(spark, sf):
    o = project.filter_extra(fx.read(spark, sf, "orders"), "o_orderstatus = 'F'")
    return project.filter_window(o, "o_orderdate", fx.INC_START, fx.INC_END)


@register("p8_whole_table", f"SELECT {ORDER_COLS} FROM orders WHERE o_orderpriority LIKE '1-%'")
def p8_whole_table(spark, sf):
    spec = TableSpec(**{**fx.ORDERS_SPEC.__dict__, "inner_where": "o_orderpriority LIKE '1-%'"})
    return source_slice(fx.read(spark, sf, "orders"), spec, fx.ORDERS_LOAD, None, None, whole_table=True)


@register("p9_query_with_params", f"""SELECT o_custkey, count(*) AS n_orders FROM orders
WHERE strftime(o_orderdate, '%Y%m%d%H%M%S') BETWEEN '{fx.INC_START}' AND '{fx.INC_END}' GROUP BY o_custkey""")
def p9_query_with_params(spark, sf):
    sql = ("SELECT o_custkey, count(*) AS n_orders FROM {orders} "
           "WHERE date_format(o_orderdate, 'yyyyMMddHHmmss') BETWEEN :start_run_id AND :end_run_id "
           "GROUP BY o_custkey")
    return project.query_with_params(spark, sql, fx.INC_START, fx.INC_END, orders=fx.read(spark, sf, "orders"))


@register("p10_on_date", "SELECT DISTINCT user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def p10_on_date(spark, sf):
    return audit.distinct_projection(project.on_date(fx.read(spark, sf, "events"), "ts", "2024-01-15"), ["user_id"])


@register("p11_filter_in", """SELECT * FROM customer WHERE c_nationkey IN (1, 2, 3, 5, 8, 13, 21)
  AND c_mktsegment = 'BUILDING'""")
def p11_filter_in(spark, sf):
    return project.filter_in(fx.read(spark, sf, "customer"), "c_nationkey", [1, 2, 3, 5, 8, 13, 21],
                             "c_mktsegment", "BUILDING")


@register("p11_filter_in_frame", f"""SELECT {ORDER_COLS} FROM orders WHERE o_custkey IN
  (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') AND o_orderstatus = 'O'""")
def p11_filter_in_frame(spark, sf):
    ids = fx.read(spark, sf, "customer").where(F.col("c_mktsegment") == "MACHINERY").select("c_custkey")
    return project.filter_in(fx.read(spark, sf, "orders"), "o_custkey", ids, "o_orderstatus", "O")


@register("p12_keep_if_null", f"""SELECT s.o_orderkey, coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice
FROM {ORDERS_NULLS_SQL} s JOIN orders t ON s.o_orderkey = t.o_orderkey""")
def p12_keep_if_null(spark, sf):
    o = fx.read(spark, sf, "orders")
    s = fx.orders_with_nulls(o).alias("s")
    t = o.alias("t")
    return s.join(t, F.col("s.o_orderkey") == F.col("t.o_orderkey")).select(
        F.col("s.o_orderkey").alias("o_orderkey"),
        project.keep_if_null(F.col("s.o_totalprice"), F.col("t.o_totalprice")).alias("o_totalprice"))


@register("p13_drop_fields_recursive", """SELECT p_partkey AS id, p_brand AS brand, p_size AS size, p_name AS name,
  'struct<id:bigint,spec:struct<brand:string,dims:struct<size:int>>,name:string>' AS attrs_type FROM part""")
def p13_drop_fields_recursive(spark, sf):
    p = fx.read(spark, sf, "part").select(F.struct(
        F.col("p_partkey").alias("id"),
        F.struct(F.col("p_brand").alias("brand"), F.col("p_type").alias("type"),
                 F.struct(F.col("p_size").alias("size"), F.col("p_retailprice").alias("price")).alias("dims"))
        .alias("spec"),
        F.col("p_name").alias("name")).alias("attrs"), F.col("p_type").alias("type"))
    out = project.drop_fields_recursive(p, ["type", "price"])
    typ = out.schema["attrs"].dataType.simpleString()
    return out.select(F.col("attrs.id").alias("id"), F.col("attrs.spec.brand").alias("brand"),
                      F.col("attrs.spec.dims.size").alias("size"), F.col("attrs.name").alias("name"),
                      F.lit(typ).alias("attrs_type"))


# ---------------------------------------------------------------- F1-F9

@register("f1_epoch_ms_to_run_id", """SELECT event_id,
  strftime(ts, '%Y%m%d%H%M%S') AS run_id_utc,
  strftime(timezone('PST8PDT', timezone('UTC', ts)), '%Y%m%d%H%M%S') AS run_id_local FROM events""")
def f1_epoch_ms_to_run_id(spark, sf):
    e = fx.read(spark, sf, "events").select("event_id", fx.epoch_ms(F.col("ts")).alias("ms"))
    return e.select("event_id", scalars.epoch_ms_to_run_id("ms").alias("run_id_utc"),
                    scalars.epoch_ms_to_run_id("ms", "PST8PDT").alias("run_id_local"))


@register("f2_run_id_to_epoch_ms", """SELECT event_id,
  CAST(epoch_us(timezone('PST8PDT', date_trunc('second', ts))) // 1000 AS VARCHAR) AS epoch_ms FROM events""")
def f2_run_id_to_epoch_ms(spark, sf):
    e = fx.read(spark, sf, "events").select("event_id", F.date_format("ts", "yyyyMMddHHmmss").alias("run_id"))
    return e.select("event_id", scalars.run_id_to_epoch_ms("run_id").alias("epoch_ms"))


def _seq_sql(f: int) -> str:
    s = f"(CAST(floor((epoch(ts) - epoch(date_trunc('day', ts))) / {f * 60}) AS INTEGER) + 1)"
    return f"CASE WHEN {s} * {f} <= 1440 THEN {s} END"


@register("f3_run_sequence", f"""SELECT event_id, {_seq_sql(30)} AS seq_30, {_seq_sql(7)} AS seq_7,
  {_seq_sql(23)} AS seq_23 FROM events""")
def f3_run_sequence(spark, sf):
    e = fx.read(spark, sf, "events")
    return e.select("event_id", scalars.run_sequence("ts", 30).alias("seq_30"),
                    scalars.run_sequence("ts", 7).alias("seq_7"), scalars.run_sequence("ts", 23).alias("seq_23"))


@register("f4_elapsed_sequences", """SELECT event_id,
  (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 900000000.0 AS elapsed FROM events""")
def f4_elapsed_sequences(spark, sf):
    e = fx.read(spark, sf, "events")
    return e.select("event_id", scalars.elapsed_sequences(F.date_trunc("DAY", "ts").cast("timestamp_ntz"),
                                                          F.col("ts"), 15).alias("elapsed"))


@register("f5_json_attr", """SELECT event_id, coalesce(json_extract_string(props, '$.k'), '-1') AS k,
  coalesce(json_extract_string(props, '$.retries'), '3') AS retries FROM events""")
def f5_json_attr(spark, sf):
    e = fx.read(spark, sf, "events")
    return e.select("event_id", scalars.json_attr("props", "k", "-1").alias("k"),
                    scalars.json_attr("props", ["retries"], "3").alias("retries"))


@register("f5_json_attr_nested", f"""WITH {CATALOG_SQL} SELECT job_key,
  coalesce(json_extract_string(job_attributes, '$.owner.id'), 'none') AS owner_id,
  coalesce(json_extract_string(job_attributes, '$.catch_up'), 'true') AS catch_up,
  coalesce(json_extract_string(job_attributes, '$.owner.name'), 'none') AS owner_name FROM jobs""")
def f5_json_attr_nested(spark, sf):
    j = fx.jobs(fx.read(spark, sf, "customer"))
    return j.select("job_key", scalars.json_attr("job_attributes", "owner.id", "none").alias("owner_id"),
                    scalars.json_attr("job_attributes", "catch_up", "true").alias("catch_up"),
                    scalars.json_attr("job_attributes", ["owner", "name"], "none").alias("owner_name"))


PART_TABLE_SQL = "upper(replace(p_name, ' ', '_')) || '_' || replace(p_type, ' ', '_')"


@register("f6_short_name", f"""SELECT p_partkey,
  lower(array_to_string(list_transform(string_split({PART_TABLE_SQL}, '_'), lambda w: substring(w, 1, 2)), ''))
    AS short2,
  lower(array_to_string(list_transform(string_split({PART_TABLE_SQL}, '_'), lambda w: substring(w, 1, 1)), ''))
    AS short1 FROM part""")
def f6_short_name(spark, sf):
    p = fx.read(spark, sf, "part").select("p_partkey", F.concat(
        F.upper(F.regexp_replace("p_name", " ", "_")), F.lit("_"), F.regexp_replace("p_type", " ", "_")).alias("t"))
    return p.select("p_partkey", scalars.short_name("t", 2).alias("short2"), scalars.short_name("t", 1).alias("short1"))


def _short_sql(n: int) -> str:
    return (f"lower(array_to_string(list_transform(string_split({PART_TABLE_SQL}, '_'), "
            f"lambda w: substring(w, 1, {n})), ''))")


F7_END, F7_NOW = "20240131235959", "20240201000000"


@register("f7_job_labels", f"""SELECT p_partkey,
  '-' || substring(p_brand, 1, 1) || '-' || {_short_sql(1)} || '-' || '{F7_END[2:]}' || '-' || CAST(p_size AS VARCHAR)
    AS job_instance_id,
  '-' || lower({PART_TABLE_SQL}) AS table_name, '' AS property, '-' || p_brand AS task,
  '-' || 'raw_tables' AS dataset, '-' || 'raw_tables' || '-' || {_short_sql(2)} AS resource_name,
  '-' || p_brand || '-' || {_short_sql(2)} || '-' || '{F7_END[2:]}' AS billing_tag,
  '-' || substring(p_brand, 1, 1) || '-' || {_short_sql(1)} || '-' || '{F7_END[2:]}' || '-' || CAST(p_size AS VARCHAR)
    AS job_run_id,
  '-' || '{F7_NOW}' AS ingestion_time FROM part""")
def f7_job_labels(spark, sf):
    p = fx.read(spark, sf, "part").select("p_partkey", "p_brand", "p_size", F.concat(
        F.upper(F.regexp_replace("p_name", " ", "_")), F.lit("_"), F.regexp_replace("p_type", " ", "_")).alias("t"))
    lab = scalars.job_labels("t", "p_brand", F.lit("raw_tables"), F.lit(F7_END), "p_size", F7_NOW)
    return p.select("p_partkey", lab.alias("l")).select("p_partkey", "l.*")


@register("f8_truncate", """SELECT doc_id, substring(text, 1, 4000) AS text_4000,
  CAST(length(substring(text, 1, 4000)) AS INTEGER) AS n FROM documents""")
def f8_truncate(spark, sf):
    d = fx.read(spark, sf, "documents")
    return d.select("doc_id", scalars.truncate("text").alias("text_4000"),
                    F.length(scalars.truncate("text")).alias("n"))


@register("f8_checksum", f"""WITH {crc32_sql("SELECT text FROM documents WHERE text IS NOT NULL")}
SELECT doc_id, crc AS checksum FROM documents d LEFT JOIN crcs ON crcs.text = d.text""")
def f8_checksum(spark, sf):
    d = fx.read(spark, sf, "documents")
    return d.select("doc_id", scalars.checksum("text").alias("checksum"))


@register("f9_partition_key", """SELECT event_id, date_trunc('hour', ts) AS p_hour, date_trunc('day', ts) AS p_day,
  date_trunc('month', ts) AS p_month, date_trunc('year', ts) AS p_year FROM events""")
def f9_partition_key(spark, sf):
    e = fx.read(spark, sf, "events")
    return e.select("event_id", *[scalars.partition_key("ts", u).alias(f"p_{u.lower()}")
                                  for u in ("HOUR", "DAY", "MONTH", "YEAR")])


# ---------------------------------------------------------------- S1-S9 (write, then read back)

def _landed_orders(spark, sf, header_rows):
    d = scratch_dir(spark, f"s1_h{header_rows}")
    sinks.write_delimited(fx.orders_as_text(fx.read(spark, sf, "orders")), d, "|", header_rows)
    raw = files.scan_delimited(spark, d, fx.ORDERS_SCHEMA_JSON, "|", header_rows)
    return project.safe_cast_all(raw, fx.ORDERS_SCHEMA_JSON)


@register("s1_scan_delimited", TEXT_ORDERS_TYPED)
def s1_scan_delimited(spark, sf):
    return _landed_orders(spark, sf, 0)


@register("s1_scan_delimited_header1", TEXT_ORDERS_TYPED)
def s1_scan_delimited_header1(spark, sf):
    return _landed_orders(spark, sf, 1)


@register("s1_scan_delimited_header2", TEXT_ORDERS_TYPED)
def s1_scan_delimited_header2(spark, sf):
    return _landed_orders(spark, sf, 2)


EVENTS_SCHEMA_JSON = {"schema": [
    {"name": "event_id", "dataType": "INT64"}, {"name": "ts", "dataType": "DATETIME"},
    {"name": "user_id", "dataType": "INT64"}, {"name": "event_type", "dataType": "STRING"},
    {"name": "value", "dataType": "FLOAT64"}, {"name": "props", "dataType": "STRING"}]}


@register("s2_scan_ndjson", """SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS event_date,
  'PST8PDT' AS source_timezone, date_trunc('day', ts) AS last_ingestion_utc_time FROM events""")
def s2_scan_ndjson(spark, sf):
    d = scratch_dir(spark, "s2")
    e = fx.read(spark, sf, "events")
    (e.withColumn("last_ingestion_utc_time", F.date_trunc("DAY", "ts"))
      .write.options(**sinks.TEXT_TIME_OPTIONS).partitionBy("last_ingestion_utc_time").json(d))
    raw = files.scan_ndjson(spark, d, EVENTS_SCHEMA_JSON, keys={"last_ingestion_utc_time": "TIMESTAMP"})
    typed = project.safe_cast_all(raw, EVENTS_SCHEMA_JSON, null_marker=False, only_non_text=True)
    out = project.add_audit_columns(typed, ["CAST(ts AS DATE) AS event_date"], "PST8PDT", layout="json")
    return out.withColumn("last_ingestion_utc_time", F.col("last_ingestion_utc_time").cast("timestamp_ntz"))


@register("s3_scan_parquet", "SELECT * FROM lineitem")
def s3_scan_parquet(spark, sf):
    d = scratch_dir(spark, "s3")
    fx.read(spark, sf, "lineitem").write.partitionBy("l_returnflag").parquet(d)
    return files.scan_parquet(spark, d, base_path=d)


@register("s4_scan_object_store", "SELECT * FROM lineitem")
def s4_scan_object_store(spark, sf):
    return files.scan_object_store(spark, "file://" + table_path(sf, "lineitem"))


@register("s4_scan_other_scheme", "SELECT l.*, o.o_orderstatus FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey")
def s4_scan_other_scheme(spark, sf):
    """Two reads of one scheme and host whose settings lead to different places."""
    here = lambda table: {"fs.viewfs.mounttable.lake.link./store": "file://" + table_path(sf, table)}
    read = lambda table: files.scan_object_store(spark, "viewfs://lake/store", here(table))
    lines, orders = read("lineitem"), read("orders")
    return lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey")


@register("s5_scan_partitioned", TEXT_ORDERS_TYPED.replace(
    "FROM orders", ", CAST(date_trunc('month', o_orderdate) AS DATE) AS load_date FROM orders"))
def s5_scan_partitioned(spark, sf):
    d = scratch_dir(spark, "s5")
    o = fx.read(spark, sf, "orders")
    month = F.to_date(F.date_trunc("MONTH", "o_orderdate"))
    text = fx.orders_as_text(o.withColumn("load_date", month), keep=("load_date",))
    lines = text.select(F.concat_ws("|", *[F.col(c) for c in text.columns if c != "load_date"]).alias("value"),
                        "load_date")
    lines.hint("rebalance", "load_date").write.partitionBy("load_date").text(d)
    raw = files.scan_delimited(spark, d, fx.ORDERS_SCHEMA_JSON, "|", 0, keys={"load_date": "DATE"})
    return project.safe_cast_all(raw, fx.ORDERS_SCHEMA_JSON)


@register("s6_scan_connector", """SELECT l_returnflag, l_linestatus, count(*) AS n,
  round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def s6_scan_connector(spark, sf):
    return connectors.scan_connector(
        spark, "parquet", {"path": table_path(sf, "lineitem")},
        "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty "
        "FROM {source} GROUP BY l_returnflag, l_linestatus")


@register("s6_scan_warehouse", """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, o_orderpriority FROM lineitem
JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' AND l_quantity >= 10 AND l_shipdate < TIMESTAMP '1998-01-01'""")
def s6_scan_warehouse(spark, sf):
    """A source query through a connector: read in four parts, with Spark's filters handed over."""
    found = connectors.scan_connector(spark, warehouse.register(spark), {"database": sf, "partitionColumn": "l_orderkey", "numPartitions": "4"},
                                      "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, l_returnflag, o_orderpriority "
                                      "FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
    wanted = (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 10) & (F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return found.where(wanted).drop("l_returnflag")


def _relative(root: str):
    """A listed path or folder below ``root``."""
    plain = root.split(":", 1)[1].lstrip("/") if ":" in root else root.lstrip("/")
    return lambda c: F.regexp_replace(c, r"^.*?" + plain + "/?", "")


@register("s8_file_inventory", """SELECT DISTINCT 'o_orderstatus=' || o_orderstatus || '/o_orderpriority=' || o_orderpriority AS folder
FROM orders""")
def s8_file_inventory(spark, sf):
    """S8 over a tree written from ``orders``: folders that hold at least one whole data file."""
    return _order_folders(spark, sf, lambda d: inventory.file_inventory(spark, d, ".parquet"))


@register("s8_list_tree", ORACLE["s8_file_inventory"])
def s8_list_tree(spark, sf):
    """The same tree, listed by the tasks."""
    return _order_folders(spark, sf, lambda d: inventory.list_tree(spark, [d if ":" in d else f"file:{d}"], ".parquet"))


def _order_folders(spark, sf, listed):
    d = scratch_dir(spark, "s8")
    o = fx.read(spark, sf, "orders").withColumn("o_orderpriority", F.col("o_orderpriority"))
    o.hint("rebalance", "o_orderstatus", "o_orderpriority").write.partitionBy("o_orderstatus", "o_orderpriority").parquet(d)
    inv = listed(d).where((F.col("length") > 0) & F.col("modificationTime").isNotNull())
    folder = F.regexp_extract(_relative(d)(F.col("path")), r"^(.*)/[^/]*$", 1)
    return inv.select(F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))).alias("folder")).distinct()


@register("s9_distinct_folders", """SELECT DISTINCT 'l_returnflag=' || l_returnflag || '/l_linestatus=' || l_linestatus AS folder
FROM lineitem""")
def s9_distinct_folders(spark, sf):
    d = scratch_dir(spark, "s9")
    fx.read(spark, sf, "lineitem").write.partitionBy("l_returnflag", "l_linestatus").parquet(d)
    found = inventory.distinct_folders(inventory.file_inventory(spark, d, ".parquet"))
    return found.select(_relative(d)(F.col("folder")).alias("folder"))


# ---------------------------------------------------------------- K1-K12

@register("k1_append_raw", "SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS o_orderdate_part FROM orders")
def k1_append_raw(spark, sf):
    d = scratch_dir(spark, "k1")
    o = fx.read(spark, sf, "orders")
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    for part in (o.where(cut), o.where(~cut)):
        sinks.append_raw(part, d, "o_orderdate", "MONTH", cluster="o_custkey")
    return spark.read.parquet(d)


@register("k2_append_with_new_fields", """SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice END AS o_totalprice FROM orders""")
def k2_append_with_new_fields(spark, sf):
    d = scratch_dir(spark, "k2")
    o = fx.read(spark, sf, "orders")
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    sinks.append_raw(o.where(cut).select("o_orderkey", "o_custkey"), d)
    sinks.append_with_new_fields(o.where(~cut).select("o_orderkey", "o_custkey", "o_totalprice"), d)
    return sinks.read_evolved(spark, d)


@register("k2_append_at_once", """SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def k2_append_at_once(spark, sf):
    """Two loads that each bring a column of their own, at the same time."""
    d = scratch_dir(spark, "k2")
    o = fx.read(spark, sf, "orders")
    third = lambda i: o.where(F.col("o_orderkey") % 3 == i)
    sinks.append_with_new_fields(third(0).select("o_orderkey", "o_custkey"), d)
    with ThreadPoolExecutor(2) as pool:
        loads = [pool.submit(sinks.append_with_new_fields, third(i).select("o_orderkey", "o_custkey", c), d)
                 for i, c in ((1, "o_totalprice"), (2, "o_orderpriority"))]
        for load in loads:
            load.result()
    return sinks.read_evolved(spark, d)


@register("k3_append_with_new_struct_fields", """SELECT CAST(c_custkey AS VARCHAR) AS ID,
  c_name AS phone_number_2, c_mktsegment AS occupation_description,
  CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) END AS occupation_description_new,
  CASE WHEN c_acctbal < 0 THEN CAST(c_nationkey AS VARCHAR) END AS occupation_description_new_1 FROM customer""")
def k3_append_with_new_struct_fields(spark, sf):
    d = scratch_dir(spark, "k3")
    c = fx.read(spark, sf, "customer")
    base = [F.col("c_name").alias("phone_number_2"), F.col("c_mktsegment").alias("occupation_description")]
    first = c.where(F.col("c_acctbal") >= 0).select(F.col("c_custkey").cast("string").alias("ID"),
                                                    F.struct(*base).alias("ATTRIBUTES"))
    second = c.where(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").cast("string").alias("ID"),
        F.struct(*base, F.lower("c_mktsegment").alias("occupation_description_new"),
                 F.col("c_nationkey").cast("string").alias("occupation_description_new_1")).alias("ATTRIBUTES"))
    sinks.append_raw(first, d)
    sinks.append_with_new_struct_fields(second, d)
    return sinks.read_evolved(spark, d).select("ID", "ATTRIBUTES.*")


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@register("k4_create_table_as", "SELECT *, CAST(date_trunc('year', o_orderdate) AS DATE) AS o_orderdate_part FROM orders")
def k4_create_table_as(spark, sf):
    return sinks.create_table_as(spark, fx.read(spark, sf, "orders"), _table_name("lakeload_k4"),
                                 scratch_dir(spark, "k4"), "o_orderdate", "YEAR", "o_custkey")


@register("k5_full_load", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def k5_full_load(spark, sf):
    d = scratch_dir(spark, "k5")
    fx.read(spark, sf, "orders").write.parquet(d)
    sinks.full_load(spark, spark.read.parquet(d).where(F.col("o_orderstatus") == "F"), d)
    return spark.read.parquet(d)


@register("k6_create_empty", """SELECT CAST(c_custkey AS VARCHAR) AS ID, c_name AS phone_number_2,
  c_mktsegment AS occupation_description FROM customer""")
def k6_create_empty(spark, sf):
    name = _table_name("lakeload_k6")
    sinks.create_empty(spark, "ID string, ATTRIBUTES struct<phone_number_2:string,occupation_description:string>",
                       name, scratch_dir(spark, "k6"))
    c = fx.read(spark, sf, "customer")
    c.select(F.col("c_custkey").cast("string").alias("ID"),
             F.struct(F.col("c_name").alias("phone_number_2"),
                      F.col("c_mktsegment").alias("occupation_description")).alias("ATTRIBUTES")) \
        .write.insertInto(name)
    return spark.table(name).select("ID", "ATTRIBUTES.*")


@register("k7_add_columns", """SELECT *, CAST(NULL AS VARCHAR) AS c_comment, CAST(NULL AS DOUBLE) AS c_score
FROM customer""")
def k7_add_columns(spark, sf):
    name = _table_name("lakeload_k7")
    fx.read(spark, sf, "customer").write.option("path", scratch_dir(spark, "k7")).saveAsTable(name)
    return sinks.add_columns(spark, name, {"c_comment": "STRING", "c_score": "FLOAT64"})


@register("k8_copy_table", "SELECT * FROM part")
def k8_copy_table(spark, sf):
    d = scratch_dir(spark, "k8")
    sinks.copy_table(spark, "parquet", {"path": table_path(sf, "part")}, "parquet", {"path": d},
                     mode="overwrite", check_data=True, preview_rows=0)
    return spark.read.parquet(d)


@register("k8_copy_warehouse", "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey")
def k8_copy_warehouse(spark, sf):
    """From one warehouse to another, both through the connector, and read back through it."""
    fmt, d = warehouse.register(spark), scratch_dir(spark, "k8")
    os.makedirs(d.removeprefix("file://"))
    sinks.copy_table(spark, fmt, {"database": sf, "partitionColumn": "c_custkey", "numPartitions": "3"}, fmt, {"database": d, "dbtable": "named"},
                     query="SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey")
    return connectors.scan_connector(spark, fmt, {"database": d, "dbtable": "named"})


@register("k9_export_csv", "SELECT * FROM events")
def k9_export_csv(spark, sf):
    d = scratch_dir(spark, "k9")
    e = fx.read(spark, sf, "events")
    sinks.export_csv(e, d)
    return sinks.read_csv_export(spark, d, e.schema)


@register("k10_relayout_history", """SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date
FROM lineitem""")
def k10_relayout_history(spark, sf):
    src, dst = scratch_dir(spark, "k10_src"), scratch_dir(spark, "k10_dst")
    li = fx.read(spark, sf, "lineitem")
    folder = F.concat(F.lit("lineitem_"), F.date_format(F.date_trunc("MONTH", "l_shipdate"), "yyyyMMdd"))
    li.withColumn("batch", folder).write.partitionBy("batch").parquet(src)
    return sinks.relayout_history(spark, src, dst, "lineitem")


@register("k10_relayout_new_folders", """SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date
FROM lineitem""")
def k10_relayout_new_folders(spark, sf):
    """A second run that moves only the folders that came after the first."""
    src, dst = scratch_dir(spark, "k10_src"), scratch_dir(spark, "k10_dst")
    li = fx.read(spark, sf, "lineitem")
    folder = F.concat(F.lit("lineitem_"), F.date_format(F.date_trunc("MONTH", "l_shipdate"), "yyyyMMdd"))
    batches, late = li.withColumn("batch", folder), F.month("l_shipdate") == 6
    batches.where(~late).write.partitionBy("batch").parquet(src)
    sinks.relayout_history(spark, src, dst, "lineitem")
    batches.where(late).write.mode("append").partitionBy("batch").parquet(src)
    return sinks.relayout_history(spark, src, dst, "lineitem")


@register("k11_table_schema", """SELECT lower(column_name) AS column_name,
  CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
    WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS data_type,
  CAST(ordinal_position AS INTEGER) AS ordinal_position
FROM information_schema.columns WHERE table_name = 'lineitem'""")
def k11_table_schema(spark, sf):
    return sinks.table_schema(spark, fx.read(spark, sf, "lineitem"))


@register("k12_list_tables")
def k12_list_tables(spark, sf):
    name = _table_name("lakeload_k12")
    fx.read(spark, sf, "region").write.option("path", scratch_dir(spark, "k12")).saveAsTable(name)
    assert sinks.table_exists(spark, name)
    return sinks.list_tables(spark).where(F.col("table_name") == name)


# ---------------------------------------------------------------- W1-W8

REQ_SQL = """req AS (SELECT c_custkey AS job_key,
    CASE c_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 4 ELSE 48 END AS seq_max,
    CAST(c_custkey % (CASE c_custkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 4 ELSE 48 END) + 1 AS INTEGER) AS seq_num,
    CASE WHEN c_custkey % 2 = 0 THEN 30 ELSE 60 END AS refresh,
    '202401' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS run_date,
    CASE WHEN c_custkey % 5 = 0 THEN 'WEEKLY' ELSE 'DAILY' END AS schedule,
    CASE WHEN c_custkey % 7 = 0 THEN '%Y%m%d075959' ELSE '%Y%m%d%H%M%S' END AS run_id_format,
    CASE WHEN c_custkey % 11 = 0 THEN '20240101000000' ELSE '99999999999999' END AS min_run_id_to_process
  FROM customer)"""


def _strftime_sql(ts: str, fmt: str) -> str:
    out = fmt
    for d in ("%Y", "%m", "%d", "%H", "%M", "%S"):
        out = f"replace({out}, '{d}', strftime({ts}, '{d}'))"
    return out


GRID_SQL = REQ_SQL + """,
gn AS (SELECT *, CAST(floor(((24.0 * CASE WHEN upper(schedule) = 'WEEKLY' THEN 7 ELSE 1 END * 60) / seq_max)
    / refresh) AS INTEGER) AS n FROM req),
gs AS (SELECT *, CAST(UNNEST(CASE WHEN n >= 1 THEN range(1, n + 1) ELSE [] END) AS INTEGER) AS seq FROM gn),
gt AS (SELECT *, strptime(run_date, '%Y%m%d') + to_microseconds(
    CAST(round((1440.0 / seq_max) * (seq_num - 1) * 60000000) AS BIGINT)
    + CAST(seq AS BIGINT) * refresh * 60000000 - 1000000) AS run_ts FROM gs),
grid AS (SELECT job_key, seq_max, seq_num, refresh, run_date, schedule, run_id_format, min_run_id_to_process,
    seq, run_ts, """ + _strftime_sql("run_ts", "run_id_format") + """ AS run_id FROM gt)"""


@register("w1_window_grid", f"WITH {GRID_SQL} SELECT job_key, seq, run_ts, run_id FROM grid")
def w1_window_grid(spark, sf):
    g = windows.window_grid(fx.window_requests(fx.read(spark, sf, "customer")))
    return g.select("job_key", "seq", "run_ts", "run_id")


@register("w2_custom_run_id", """SELECT event_id, strftime(ts, '%Y%m%d') || '075959' AS fixed_time,
  strftime(ts, '%Y%m%d%H%M%S') AS default_id FROM events""")
def w2_custom_run_id(spark, sf):
    e = fx.read(spark, sf, "events")
    return e.select("event_id", windows.custom_run_id(F.col("ts"), F.lit("%Y%m%d075959")).alias("fixed_time"),
                    windows.custom_run_id(F.col("ts"), F.lit("%Y%m%d%H%M%S")).alias("default_id"))


W3_NOW = "20240112120000"
CURRENT_SQL = GRID_SQL + f""",
c1 AS (SELECT *, min(CASE WHEN run_id > '{W3_NOW}' THEN seq END) OVER (PARTITION BY job_key) AS first_gt FROM grid),
c2 AS (SELECT *, coalesce(max(CASE WHEN seq < coalesce(first_gt, 1073741824) THEN seq END)
    OVER (PARTITION BY job_key), 1) AS pick FROM c1),
cur AS (SELECT job_key, seq_max, seq_num, refresh, run_date, schedule, run_id_format, min_run_id_to_process,
    seq, run_ts, run_id FROM c2 WHERE seq_max <> 1 OR seq = pick)"""


@register("w3_current_window", f"WITH {CURRENT_SQL} SELECT job_key, seq, run_id FROM cur")
def w3_current_window(spark, sf):
    g = windows.window_grid(fx.window_requests(fx.read(spark, sf, "customer")))
    return windows.current_window(g, W3_NOW).select("job_key", "seq", "run_id")


# per job: its ids in grid order, its last run, what is pending by the rules, then one
# row per pending id or one status row; every requested job must be there
W4_SQL = CURRENT_SQL + """,
lr AS (SELECT job_key, CASE job_key % 6 WHEN 1 THEN 'FAILED' WHEN 2 THEN 'COMPLETED' WHEN 3 THEN 'COMPLETED'
      WHEN 4 THEN 'COMPLETED' END AS status,
    CASE WHEN job_key % 6 = 4 THEN '19000101000000' ELSE run_id END AS last_run_id
  FROM (SELECT *, max(seq) OVER (PARTITION BY job_key) AS n FROM cur)
  WHERE seq = CASE job_key % 6 WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN n WHEN 4 THEN 1 WHEN 5 THEN 1 END),
facts AS (SELECT r.job_key, r.min_run_id_to_process AS floor_id, lr.job_key IS NOT NULL AS has_last, lr.status, lr.last_run_id,
    (SELECT count(*) FROM cur c WHERE c.job_key = r.job_key) AS ids,
    (SELECT min(c.seq) FROM cur c WHERE c.job_key = r.job_key AND c.run_id = lr.last_run_id) AS at
  FROM req r LEFT JOIN lr ON lr.job_key = r.job_key),
todo AS (SELECT c.job_key, c.seq, c.run_id FROM cur c JOIN facts f ON f.job_key = c.job_key
  WHERE NOT f.has_last OR (f.status = 'FAILED' AND c.seq >= f.at) OR (f.status = 'COMPLETED' AND c.seq > f.at)),
head AS (SELECT job_key, arg_min(run_id, seq) AS first_id FROM todo GROUP BY job_key),
verdict AS (SELECT f.job_key,
    CASE WHEN f.has_last AND f.status = 'FAILED' AND f.last_run_id IS NOT NULL THEN 'Y' ELSE 'N' END AS rerun,
    CASE WHEN f.ids = 0 THEN 'ERROR_EMPTY_GRID'
      WHEN h.first_id > f.floor_id THEN 'SKIPPED'
      WHEN h.first_id IS NOT NULL THEN 'PENDING'
      WHEN f.status IS NULL OR f.last_run_id IS NULL THEN 'ERROR_MISSING_STATUS_OR_RUN_ID'
      WHEN f.at IS NULL THEN 'ERROR_UNKNOWN_LAST_RUN_ID'
      WHEN f.status NOT IN ('FAILED', 'COMPLETED') THEN 'ERROR_UNKNOWN_STATUS' ELSE 'DONE' END AS status
  FROM facts f LEFT JOIN head h ON h.job_key = f.job_key)"""


@register("w4_pending_windows", f"""WITH {W4_SQL}
SELECT v.job_key, t.seq, t.run_id, v.rerun AS rerun_indicator, v.status
FROM verdict v LEFT JOIN todo t ON t.job_key = v.job_key AND v.status = 'PENDING'""")
def w4_pending_windows(spark, sf):
    g = windows.window_grid(fx.window_requests(fx.read(spark, sf, "customer")), keep_empty=True)
    g = windows.current_window(g, W3_NOW)
    return windows.pending_windows(g, fx.last_runs(g))


SPLIT_SQL = """sr AS (SELECT c_custkey AS job_key,
    CASE c_custkey % 4 WHEN 0 THEN 15 WHEN 1 THEN 7 WHEN 2 THEN 10 ELSE 60 END AS job_frequency,
    '202401' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS run_date,
    '202401' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 24 AS VARCHAR), 2, '0')
      || CASE WHEN c_custkey % 2 = 0 THEN '00' ELSE '30' END || '00' AS run_datetime,
    CAST(c_custkey % 48 + 1 AS INTEGER) AS seq_num, c_custkey % 9 = 0 AS catch_up FROM customer)"""


@register("w5_split_windows", f"""WITH {SPLIT_SQL},
s1 AS (SELECT *, job_frequency < 30 AND NOT catch_up AS small,
    job_frequency < 30 AND 30 % job_frequency <> 0 AS bad FROM sr),
s2 AS (SELECT *, UNNEST(CASE WHEN small AND NOT bad THEN range(0, 30 // job_frequency) ELSE [0] END) AS k FROM s1)
SELECT job_key, job_frequency, run_date, run_datetime, seq_num, catch_up,
  CASE WHEN small AND NOT bad THEN strftime(strptime(run_datetime, '%Y%m%d%H%M%S')
    + to_minutes(CAST(k * job_frequency AS BIGINT)), '%Y%m%d%H%M%S') ELSE run_datetime END AS sub_run_datetime,
  CASE WHEN small AND NOT bad THEN CAST(trunc((epoch(strptime(run_datetime, '%Y%m%d%H%M%S'))
      - epoch(strptime(run_date, '%Y%m%d'))) / 60.0 / job_frequency + k + 1) AS INTEGER)
    WHEN bad THEN NULL ELSE seq_num END AS sub_seq,
  CASE WHEN bad THEN 'ERROR_FREQUENCY' WHEN small THEN 'SPLIT'
    WHEN catch_up AND job_frequency < 30 THEN 'CATCH_UP' ELSE 'SINGLE' END AS status FROM s2""")
def w5_split_windows(spark, sf):
    return windows.split_windows(fx.split_requests(fx.read(spark, sf, "customer")), 30, catch_up_col="catch_up")


W6_NOW = "20240115000000"


@register("w6_catch_up", f"""WITH cu AS (SELECT user_id AS job_key,
    CASE WHEN event_id % 2 = 0 THEN 15 ELSE 30 END AS job_frequency,
    strftime(date_trunc('minute', ts), '%Y%m%d%H%M%S') AS run_datetime,
    '{{"catch_up": "' || CASE WHEN user_id % 3 = 0 THEN 'false' ELSE 'true' END || '"}}' AS job_attributes
  FROM events),
done AS (SELECT DISTINCT user_id AS job_key,
    CAST(epoch(timezone('America/Los_Angeles', date_trunc('minute', ts) + INTERVAL 15 MINUTE)) AS BIGINT) * 1000 AS ms
  FROM events WHERE event_type = 'purchase')
SELECT cu.*, coalesce(job_frequency < 30
    AND strptime('{W6_NOW}', '%Y%m%d%H%M%S') > strptime(run_datetime, '%Y%m%d%H%M%S') + INTERVAL 2 HOUR
    AND lower(coalesce(json_extract_string(job_attributes, '$.catch_up'), 'true')) = 'true'
    AND NOT EXISTS (SELECT 1 FROM done d WHERE d.job_key = cu.job_key AND d.ms =
      CAST(epoch(timezone('America/Los_Angeles', strptime(run_datetime, '%Y%m%d%H%M%S')
        + to_minutes(CAST(job_frequency AS BIGINT)))) AS BIGINT) * 1000), false) AS catch_up
FROM cu""")
def w6_catch_up(spark, sf):
    e = fx.read(spark, sf, "events")
    return windows.catch_up(fx.catch_up_requests(e), fx.committed_runs(e), W6_NOW)


W7_TODAY = "20240120"


@register("w7_validate_requests", f"""WITH v AS (SELECT c_custkey AS job_key, CAST(c_custkey % 50 AS INTEGER) AS seq_num,
    48 AS seq_max, CASE c_custkey % 4 WHEN 0 THEN '20240115' WHEN 1 THEN '20240230' WHEN 2 THEN '20250101'
      ELSE '2024011' END AS run_date FROM customer),
s AS (SELECT *, CASE WHEN seq_num > seq_max THEN 'ERROR_SEQ_NUM'
    WHEN NOT (regexp_full_match(run_date, '\\d{{8}}') AND try_strptime(run_date, '%Y%m%d') IS NOT NULL)
      THEN 'ERROR_RUN_DATE'
    WHEN run_date > '{W7_TODAY}' THEN 'ERROR_FUTURE_RUN_DATE' ELSE 'OK' END AS status FROM v)
SELECT *, CASE WHEN status = 'OK' THEN run_date < '{W7_TODAY}' END AS catchup FROM s""")
def w7_validate_requests(spark, sf):
    return windows.validate_requests(fx.validation_requests(fx.read(spark, sf, "customer")), W7_TODAY)


@register("w8_run_attributes", f"""WITH cat AS ({J1_SQL}),
r AS (SELECT *, '20240115' || lpad(CAST(job_key % 24 AS VARCHAR), 2, '0') || '3000' AS run_datetime,
    job_key % 48 + 1 AS seq FROM cat)
SELECT job_key, job_name,
  CASE WHEN lower(coalesce(json_extract_string(logic_attributes, '$.runtime_in_ms_enabled'), 'true')) = 'true'
    THEN CAST(epoch(timezone('America/Los_Angeles', strptime(run_datetime, '%Y%m%d%H%M%S')
      + to_minutes(CAST(job_frequency_code AS BIGINT)))) AS BIGINT) * 1000
    ELSE CAST(epoch(timezone('America/Los_Angeles', strptime(run_datetime, '%Y%m%d%H%M%S'))) AS BIGINT) END
    AS job_runtime_ms,
  seq AS job_run_sequence, job_frequency_code, application_system_key AS system_key, data_entity_key,
  CASE WHEN lower(coalesce(json_extract_string(logic_attributes, '$.runtime_in_ms_enabled'), 'true')) = 'true'
    AND related_job_key IS NOT NULL THEN related_job_key END AS parent_job_key
FROM r""")
def w8_run_attributes(spark, sf):
    cat = joins.catalog_join(**catalog_frames(spark, sf), chain_name=fx.CHAIN)
    r = cat.select("*", F.concat(F.lit("20240115"), F.lpad((F.col("job_key") % 24).cast("string"), 2, "0"),
                                 F.lit("3000")).alias("run_datetime"),
                   (F.col("job_key") % 48 + 1).alias("seq"), F.col("job_frequency_code").alias("job_frequency"))
    return windows.run_attributes(r)


# ---------------------------------------------------------------- N1-N4

STATS_BASE_SQL = """sb AS (SELECT l_orderkey AS k, l_linenumber AS ln, l_partkey AS p, l_suppkey AS s,
    'job_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS jid,
    CASE WHEN l_linenumber > 1 THEN 'script_' || l_orderkey END AS parent,
    epoch_us(l_shipdate) // 1000 AS st, epoch_us(l_shipdate) // 1000 + CAST(l_quantity * 1000 AS BIGINT) AS en,
    *, CAST(epoch_us(timezone('PST8PDT', l_shipdate)) // 1000 AS VARCHAR) AS end_time_ms,
    'job_' || (l_suppkey % 10) AS job_name FROM lineitem),
sj AS (SELECT *, CASE WHEN parent IS NOT NULL THEN parent || ':' || jid ELSE jid END AS job_id FROM sb)"""

N1_TEXT = """'MERGE INTO snapshot_' || (p % 50) || ' USING raw_' || s || ' '
    || repeat('x', CAST(CAST(trunc(l_extendedprice) AS BIGINT) % 5000 AS INTEGER))"""

N1_SELECT = f"""SELECT end_time_ms, ln AS seq_num, job_id, job_name, 'JOB' AS query_type,
  substring({N1_TEXT}, 1, 4000) AS query,
  CASE WHEN l_discount > 0.05 THEN 'raw_tables:snapshot_' || (p % 50) ELSE 'NO_TARGET_SPECIFIED' END AS db_name,
  st AS init_time, en AS end_time,
  coalesce(CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END, '0') AS record_count,
  (en - st) / 1000.0 AS time_taken FROM sj"""

N2_SELECT = """SELECT end_time_ms, ln AS seq_num, job_id, job_name, 'STAGE' AS query_type,
  CASE p % 7 WHEN 0 THEN '$1, FROM' WHEN 1 THEN '$1:l_orderkey' ELSE '$1:l_orderkey, FROM part_' || p END AS query,
  CASE p % 7 WHEN 0 THEN '' WHEN 1 THEN 'Input stage : ' ELSE 'part_' || p END AS db_name,
  st AS init_time, st + 500 AS end_time, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS record_count,
  0.5 AS time_taken FROM sj WHERE l_linestatus <> 'O'
UNION ALL
SELECT end_time_ms, ln, job_id, job_name, 'STAGE',
  'COMPUTE:$' || s || ', sum($2)__::__ WRITE:__stage01_output', 'Input stage : S00',
  st + 500, en, CAST(ln AS VARCHAR), (en - st - 500) / 1000.0 FROM sj WHERE l_linestatus <> 'O'"""

STAT_FIELDS = [c for c in jobstats.STAT_COLUMNS if c != "checksum"]


def _stats(spark, sf):
    return fx.job_statistics(fx.read(spark, sf, "lineitem"))


@register("n1_job_stats", f"WITH {STATS_BASE_SQL} {N1_SELECT}")
def n1_job_stats(spark, sf):
    return jobstats.job_stats(_stats(spark, sf)).select(*STAT_FIELDS)


@register("n1_job_stats_checksum", f"""WITH {STATS_BASE_SQL}, texts AS (SELECT *, {N1_TEXT} AS text FROM sj),
{crc32_sql("SELECT text FROM texts")}
SELECT r.* EXCLUDE (text), crc AS checksum FROM ({N1_SELECT.replace("AS time_taken FROM sj", "AS time_taken, text FROM texts")}) r JOIN crcs USING (text)""")
def n1_job_stats_checksum(spark, sf):
    return jobstats.job_stats(_stats(spark, sf))


@register("n2_stage_stats", f"WITH {STATS_BASE_SQL} {N2_SELECT}")
def n2_stage_stats(spark, sf):
    return jobstats.stage_stats(_stats(spark, sf)).select(*STAT_FIELDS)


@register("n2_stage_stats_checksum", f"""WITH {STATS_BASE_SQL}, q AS ({N2_SELECT}),
{crc32_sql("SELECT query AS text FROM q")}
SELECT q.*, crc AS checksum FROM q JOIN crcs ON crcs.text = q.query""")
def n2_stage_stats_checksum(spark, sf):
    return jobstats.stage_stats(_stats(spark, sf))


@register("n3_stage_source", f"""WITH {STATS_BASE_SQL}, q AS ({N2_SELECT})
SELECT job_id, query, db_name FROM q""")
def n3_stage_source(spark, sf):
    st = _stats(spark, sf).select(jobstats.full_job_id(_stats(spark, sf)).alias("job_id"),
                                  F.explode("statistics.query.queryPlan").alias("s"))
    text = jobstats.stage_text(F.col("s"))
    return st.select("job_id", text.alias("query"),
                     jobstats.stage_source(F.col("s.name"), text, F.col("s.inputStages")).alias("db_name"))


@register("n4_all_stats", f"WITH {STATS_BASE_SQL} {N1_SELECT} UNION ALL {N2_SELECT}")
def n4_all_stats(spark, sf):
    return jobstats.all_stats(_stats(spark, sf)).select(*STAT_FIELDS)


# ---------------------------------------------------------------- L1, L2

LAYER_ROWS_SQL = """lp AS (SELECT p_partkey // 6 AS entity, CAST(p_partkey % 6 AS INTEGER) AS layer, * FROM part),
lrows AS (
  SELECT entity, layer, ['brand'] AS path, p_brand AS value FROM lp WHERE layer IN (0, 1, 3)
  UNION ALL SELECT entity, layer, ['spec', 'type'], p_type FROM lp WHERE layer IN (0, 4)
  UNION ALL SELECT entity, layer, ['spec', 'size'], CAST(p_size AS VARCHAR) FROM lp WHERE layer IN (0, 2)
  UNION ALL SELECT entity, layer, ['tags'], '[' || p_size || ',' || p_size || ']' FROM lp WHERE layer = 3
  UNION ALL SELECT entity, layer, ['size_class'], CASE WHEN p_size > 25 THEN 'L' ELSE 'S' END FROM lp WHERE layer = 5)"""


@register("l1_resolve_layers", f"""WITH {LAYER_ROWS_SQL}
SELECT entity, array_to_string(path, '/') AS path, arg_max(value, layer) AS value, max(layer) AS layer
FROM lrows GROUP BY ALL""")
def l1_resolve_layers(spark, sf):
    return _slashed(layers.resolve_layers(fx.layered_attributes(fx.read(spark, sf, "part"))))


def _slashed(df):
    """The path array as one text (no key here holds a slash)."""
    return df.withColumn("path", F.array_join("path", "/"))


@register("l1_resolve_layers_odd", """WITH o AS (SELECT p_partkey AS entity, p_brand AS b, p_size AS s,
    CASE WHEN p_partkey % 2 = 0 THEN 12 ELSE 3 END AS depth FROM part),
k AS (SELECT entity, b, s, depth, [('k' || i) FOR i IN range(1, depth + 1)] AS ks FROM o),
r AS (
  SELECT entity, 0 AS layer, ['text'] AS path, '{' || b || '}' AS value FROM k
  UNION ALL SELECT entity, 0, ['dot.ted'], CAST(s AS VARCHAR) FROM k
  UNION ALL SELECT entity, 0, ['dot', 'ted'], '0' FROM k
  UNION ALL SELECT entity, 0, ['bare'], '{}' FROM k
  UNION ALL SELECT entity, 1, ['filled', 'x'], '["' || b || '"]' FROM k
  UNION ALL SELECT entity, 1, list_append(ks[1:i], 'n'), CAST(i AS VARCHAR) FROM k, unnest(range(0, depth)) AS t(i)
  UNION ALL SELECT entity, 1, ks, b FROM k)
SELECT entity, array_to_string(path, '/') AS path, value, layer FROM r""")
def l1_resolve_layers_odd(spark, sf):
    """Values that look like objects, dotted keys, empty objects, and nesting of 3 or 12 levels."""
    return _slashed(layers.resolve_layers(fx.odd_attributes(fx.read(spark, sf, "part"))))


@register("l1_repeated_keys", """SELECT p_partkey AS entity, 'a' AS path, CAST(p_size AS VARCHAR) AS value, 0 AS layer FROM part
UNION ALL SELECT p_partkey, 'b/d', p_type, 0 FROM part WHERE p_partkey % 5 <> 0""")
def l1_repeated_keys(spark, sf):
    """Documents that repeat keys (the last one wins); every fifth one's second layer is no JSON and has no say."""
    return _slashed(layers.resolve_layers(fx.repeated_keys(fx.read(spark, sf, "part"))))


@register("l2_no_json", """SELECT p_partkey AS entity, '' AS path, 'no JSON document in layer 1' AS error FROM part WHERE p_partkey % 5 = 0""")
def l2_no_json(spark, sf):
    return _slashed(layers.layer_conflicts(fx.repeated_keys(fx.read(spark, sf, "part"))))


@register("l2_layer_conflicts", """WITH lp AS (SELECT p_partkey // 6 AS entity, p_partkey % 6 AS layer, * FROM part)
SELECT DISTINCT a.entity, 'spec' AS path, 'layers disagree whether this key is an object: spec' AS error
FROM lp a JOIN lp b ON a.entity = b.entity
WHERE a.layer = 5 AND a.p_size > 40 AND b.layer IN (0, 2, 4)""")
def l2_layer_conflicts(spark, sf):
    return _slashed(layers.layer_conflicts(fx.layered_attributes(fx.read(spark, sf, "part"), conflicts=True)))


# ---------------------------------------------------------------- R1

@register("r1_retention_candidates", """WITH keep AS (SELECT o_orderkey, o_custkey, date_part('year', o_orderdate) AS y,
    o_orderstatus AS s FROM orders)
SELECT DISTINCT 'plain/' || y || '_dly.txt' AS file FROM keep
UNION SELECT DISTINCT 'deep/' || s || '/' || y || '_dly.txt' FROM keep""")
def r1_retention_candidates(spark, sf):
    """R1 on an inventory derived from ``orders``: files in a plain rule's folder and below a
    recursive rule's one; protected names, other suffixes, other folders and files below a
    plain rule's folder stay."""
    o = fx.read(spark, sf, "orders").select(F.year("o_orderdate").cast("string").alias("y"), F.col("o_orderstatus").alias("s")).distinct()
    name = F.concat("y", F.lit("_dly.txt"))
    paths = F.array(F.concat(F.lit("file:/lake/plain/"), name), F.concat(F.lit("file:/lake/plain/below/"), name),
                    F.concat(F.lit("file:/lake/deep/"), "s", F.lit("/"), name), F.concat(F.lit("file:/lake/other/"), name),
                    F.concat(F.lit("file:/lake/deep/"), "s", F.lit("/connection_pool_"), name),
                    F.concat(F.lit("file:/lake/plain/"), "y", F.lit(".csv")))
    inv = o.select(F.explode(paths).alias("path")).withColumn("modificationTime", F.to_timestamp(F.lit("2020-01-01 00:00:00")))
    config = {"_dly.txt": {"directories": ["/lake/plain"], "recursive_directories": ["/lake/deep"], "retention_days": 10}}
    got = retention.retention_candidates(inv, retention.rules_frame(spark, config), "2100-01-01 00:00:00")
    return got.select(F.regexp_replace("file", "^/lake/", "").alias("file"))


# ---------------------------------------------------------------- streaming landing (S1 + P1 + P4 + K1)

@register("s1_land_files_stream", TEXT_ORDERS_TYPED.replace("FROM orders", ", 'PST8PDT' AS source_timezone FROM orders"))
def s1_land_files_stream(spark, sf):
    from ..streaming.landing import land_files_stream
    src, raw, ckpt = scratch_dir(spark, "st_src"), scratch_dir(spark, "st_raw"), scratch_dir(spark, "st_ckpt")
    text = fx.orders_as_text(fx.read(spark, sf, "orders"))
    cut = F.col("o_orderdate") < F.lit("1998")  # text dates; 'NULL' sorts after digits
    for i, part in enumerate((text.where(cut), text.where(~cut))):
        sinks.write_delimited(part, f"{src}/batch{i}", "|", header_rows=2)
        q = land_files_stream(spark, f"{src}/*", raw, ckpt, fx.ORDERS_SCHEMA_JSON, "|", header_rows=2,
                              partition_field="o_orderdate", partition_unit="YEAR")
        q.awaitTermination()
    cols = [f["name"] for f in fx.ORDERS_SCHEMA_JSON["schema"]]
    return spark.read.parquet(raw).select(*cols, "source_timezone")


@register("m1_merge_upsert_bucketed", ORACLE["m1_merge_upsert"])
def m1_merge_upsert_bucketed(spark, sf):
    """M1 through a snapshot table bucketed by customer: the merge join reads the
    snapshot without shuffling it."""
    from .upsert import run_upsert_bucketed
    orders = fx.read(spark, sf, "orders")
    name = _table_name("lakeload_m1b")
    spec = TableSpec(**{**fx.ORDERS_SPEC.__dict__, "partition_column": "o_orderdate_part", "buckets": 8,
                        "inner_where": f"o_orderdate < TIMESTAMP_NTZ '{fx.SNAPSHOT_BEFORE} 00:00:00'"})
    run_upsert_bucketed(spark, orders, name, spec, fx.ORDERS_LOAD, None, None, whole_table=True,
                        path=scratch_dir(spark, "m1b"))
    spec = TableSpec(**{**spec.__dict__, "inner_where": None})
    run_upsert_bucketed(spark, orders, name, spec, fx.ORDERS_LOAD, fx.INC_START, fx.INC_END)
    return spark.table(name).drop("o_orderdate_part")


# ---------------------------------------------------------------- batch landing (S1 + S5 + P1 + P2 + P4 + K1)

@register("k1_land_delimited", "SELECT *, CAST(o_orderdate AS DATE) AS order_day, 'PST8PDT' AS source_timezone FROM ("
          + TEXT_ORDERS_TYPED.replace("FROM orders", ", date_trunc('year', o_orderdate) AS last_ingestion_utc_time "
                                                     "FROM orders") + ")")
def k1_land_delimited(spark, sf):
    from .landing import land_delimited
    src, raw = scratch_dir(spark, "land_src"), scratch_dir(spark, "land_raw")
    o = fx.read(spark, sf, "orders")
    key = F.date_format(F.date_trunc("YEAR", "o_orderdate"), "yyyy-MM-dd HH:mm:ss")
    text = fx.orders_as_text(o.withColumn("last_ingestion_utc_time", key), keep=("last_ingestion_utc_time",))
    lines = text.select(F.concat_ws("|", *[F.col(c) for c in text.columns if c != "last_ingestion_utc_time"])
                        .alias("value"), "last_ingestion_utc_time")
    lines.hint("rebalance", "last_ingestion_utc_time").write.partitionBy("last_ingestion_utc_time").text(src)
    land_delimited(spark, src, raw, fx.ORDERS_SCHEMA_JSON, "|", 0,
                   audit_exprs=["CAST(o_orderdate AS DATE) AS order_day"], key_type="DATETIME",
                   partition_field="o_orderdate", partition_unit="YEAR", cluster="o_custkey")
    return spark.read.parquet(raw).drop("o_orderdate_part")


@register("d2_latest_by_window_composite", latest_sql(
    "lineitem", "l_orderkey, l_linenumber", "l_shipdate, l_partkey, l_suppkey", LINE_COLS))
def d2_latest_by_window_composite(spark, sf):
    """D2 on the same input as ``d1_latest_by_agg_composite``, to compare the forms."""
    return dedup.latest_by_window(fx.read(spark, sf, "lineitem"), fx.LINE_KEYS, fx.LINE_ORDER, rank_col=None)


@register("s5_scan_partitioned_parquet", """SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month
FROM lineitem""")
def s5_scan_partitioned_parquet(spark, sf):
    """Hive folders ``ship_month=yyyy-MM-dd`` read with the key declared as DATE."""
    d = scratch_dir(spark, "s5p")
    li = fx.read(spark, sf, "lineitem")
    (li.withColumn("ship_month", F.date_format(F.date_trunc("MONTH", "l_shipdate"), "yyyy-MM-dd"))
       .hint("rebalance", "ship_month").write.partitionBy("ship_month").parquet(d))
    return files.scan_partitioned(spark, d, "parquet", li.schema, {"ship_month": "DATE"})


@register("k3_union_evolved", """SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice END AS o_totalprice FROM orders""")
def k3_union_evolved(spark, sf):
    """K2/K3 in the plan: a later batch adds a struct member and a column."""
    o = fx.read(spark, sf, "orders")
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    old = o.where(cut).select("o_orderkey", F.struct("o_custkey").alias("s"))
    new = o.where(~cut).select("o_orderkey", F.struct("o_custkey", "o_orderstatus").alias("s"), "o_totalprice")
    return sinks.union_evolved(old, new).select("o_orderkey", "s.o_custkey", "s.o_orderstatus", "o_totalprice")


@register("a7_audit_catalog_tables", f"{A7_CTES}\nSELECT{A7_ORDERS_COUNTS}")
def a7_audit_catalog_tables(spark, sf):
    """A7 over catalog tables named by the rule <t>_raw / <t> (table name dropped: it is generated)."""
    orders = fx.read(spark, sf, "orders")
    name = _table_name("lakeload_a7")
    orders.write.option("path", scratch_dir(spark, "a7_raw")).saveAsTable(f"{name}_raw")
    fx.orders_snapshot(orders).write.option("path", scratch_dir(spark, "a7_snap")).saveAsTable(name)
    hist = F.col("o_orderdate") == F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
    return audit.audit_catalog_tables(spark, [(name, list(fx.ORDERS_KEYS), hist)]).drop("table_name")


@register("p6_filter_window_partitioned", f"""SELECT {ORDER_COLS},
  CAST(date_trunc('month', o_orderdate) AS DATE) AS o_orderdate_part FROM orders WHERE {INC_WINDOW}""")
def p6_filter_window_partitioned(spark, sf):
    """P6 on a raw table partitioned by the month of the audit column: the window
    also becomes a partition filter, so only the window's folders are listed."""
    d = scratch_dir(spark, "p6p")
    sinks.append_raw(fx.read(spark, sf, "orders"), d, "o_orderdate", "MONTH")
    return project.filter_window(spark.read.parquet(d), "o_orderdate", fx.INC_START, fx.INC_END,
                                 partition_column="o_orderdate_part", partition_unit="MONTH")


# ---------------------------------------------------------------- TIMESTAMP (instant) columns

INSTANT_ORDERS = "(SELECT *, epoch_us(o_orderdate) + o_orderkey % 86400 * 1000000 AS us FROM orders)"


def _instant_orders(spark, sf):
    """``orders`` with an instant spread over the day, and no other time column."""
    o = fx.read(spark, sf, "orders")
    loaded = F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, scalars.ntz_to_instant(F.col("o_orderdate")))
    return o.select("o_orderkey", loaded.alias("loaded"))


@register("f9_partition_key_instant", f"""SELECT o_orderkey, date_trunc('hour', make_timestamp(us)) AS p_hour,
  date_trunc('day', make_timestamp(us)) AS p_day, date_trunc('month', make_timestamp(us)) AS p_month,
  date_trunc('year', make_timestamp(us)) AS p_year FROM {INSTANT_ORDERS}""")
def f9_partition_key_instant(spark, sf):
    """F9 on TIMESTAMP columns: UTC units whatever the session zone."""
    return _instant_orders(spark, sf).select("o_orderkey", *[
        scalars.partition_key("loaded", u).alias(f"p_{u.lower()}") for u in ("HOUR", "DAY", "MONTH", "YEAR")])


@register("p6_filter_window_instant", f"""SELECT o_orderkey, CAST(make_timestamp(us) AS DATE) AS loaded_part
FROM {INSTANT_ORDERS} WHERE make_timestamp(us) BETWEEN {bound(fx.INC_START)} AND {bound(fx.INC_END)}""")
def p6_filter_window_instant(spark, sf):
    """P6 with a partition filter on a raw table partitioned by the day of a TIMESTAMP column (K1)."""
    d = scratch_dir(spark, "p6i")
    sinks.append_raw(_instant_orders(spark, sf), d, "loaded", "DAY")
    out = project.filter_window(spark.read.parquet(d), "loaded", fx.INC_START, fx.INC_END, partition_column="loaded_part")
    return out.select("o_orderkey", "loaded_part")


@register("upsert_columns_null_partitions", f"""WITH {NULL_SNAP_CTE},
sl AS (SELECT * FROM {NULL_SLICE}),
src AS ({latest_sql('sl', 'o_custkey', 'o_orderdate, o_orderkey', ORDER_COLS)}),
touched AS (SELECT DISTINCT date_trunc('year', coalesce(o_orderdate, TIMESTAMP '1970-01-01')) AS p FROM sl),
tin AS (SELECT * FROM snap WHERE date_trunc('year', o_orderdate) IN (SELECT p FROM touched) OR o_orderdate IS NULL),
trest AS (SELECT * FROM snap EXCEPT ALL SELECT * FROM tin)
SELECT * FROM trest
UNION ALL SELECT t.* FROM tin t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.o_custkey = t.o_custkey)
UNION ALL SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, CASE WHEN {DEFAULT_GUARD} THEN s.o_totalprice ELSE t.o_totalprice END,
  t.o_orderdate, t.o_orderpriority FROM tin t JOIN src s ON s.o_custkey = t.o_custkey
UNION ALL SELECT NULL, s.o_custkey, NULL, s.o_totalprice, NULL, NULL FROM src s
  WHERE NOT EXISTS (SELECT 1 FROM tin t WHERE t.o_custkey = s.o_custkey)""")
def upsert_columns_null_partitions(spark, sf):
    """The writing path with a column list that lacks the partition field: inserted rows
    have no partition and must still reach the snapshot."""
    from .upsert import run_upsert
    o = fx.orders_with_nulls(fx.read(spark, sf, "orders"))
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    lo, hi = project.window_bounds(o, "o_orderdate", fx.INC_START, fx.INC_END)
    spec = _null_spec(partition_column="o_orderdate_part")
    path = scratch_dir(spark, "upsert_columns")
    run_upsert(spark, o.where((F.col("o_orderdate") < cut) | F.col("o_orderdate").isNull()), path, spec, fx.ORDERS_LOAD,
               None, None, whole_table=True)
    run_upsert(spark, o.where(F.col("o_orderdate").between(lo, hi) | F.col("o_orderdate").isNull()), path, spec, fx.ORDERS_LOAD,
               None, None, columns=["o_custkey", "o_totalprice"], whole_table=True)
    return spark.read.parquet(path).drop("o_orderdate_part")


def _snapshot_path(spark, sf, spec):
    """A snapshot of the orders before 1998, then one window of all orders, both by the writing path."""
    from .upsert import run_upsert
    orders, path = fx.read(spark, sf, "orders"), scratch_dir(spark, "upsert_files")
    early = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    run_upsert(spark, early, path, spec, fx.ORDERS_LOAD, None, None, whole_table=True)
    run_upsert(spark, orders, path, spec, fx.ORDERS_LOAD, fx.INC_START, fx.INC_END)
    return path


def _snapshot_then_window(spark, sf, spec):
    return spark.read.parquet(_snapshot_path(spark, sf, spec)).select(*fx.read(spark, sf, "orders").columns)


@register("m1_upsert_by_files", ORACLE["m1_merge_upsert"])
def m1_upsert_by_files(spark, sf):
    """The merge that rewrites only the files that hold a key of the window."""
    return _snapshot_then_window(spark, sf, TableSpec(**{**fx.ORDERS_SPEC.__dict__, "partition_column": "o_orderdate_part", "rewrite": "files"}))


@register("m1_upsert_unpartitioned", merge_sql(SNAP_CTE, f"orders WHERE {INC_WINDOW}", DEFAULT_GUARD, ALL_UPDATE, ALL_INSERT, YEAR_SCOPE)
          .replace("{null_scope}", "OR true"))
def m1_upsert_unpartitioned(spark, sf):
    """The same into a snapshot without a partition field: every row is in scope, and only files with a key are rewritten."""
    return _snapshot_then_window(spark, sf, TableSpec(**{**fx.ORDERS_SPEC.__dict__, "partition_field": None, "partition_column": None}))

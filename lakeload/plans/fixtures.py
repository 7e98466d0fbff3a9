"""Frames the registered checks derive from the test tables (shapes of FIXTURES.md §3).

Every frame here is a Spark transformation of a given table, so its size grows
with the data. The oracle SQL in ``registry.py`` derives the same shapes with the
same expressions.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import ntz_lit
from ..operators.dedup import latest_by_agg
from ..session import table_path
from ..spec import LoadSpec, TableSpec

# Fixed values of the checks: key / order columns and run windows.
ORDERS_KEYS = ("o_custkey",)
ORDERS_ORDER = ("o_orderdate", "o_orderkey")
LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey")
EVENT_KEYS = ("user_id", "event_type")
EVENT_ORDER = ("ts", "event_id")
SNAPSHOT_BEFORE = "1998-01-01"
INC_START, INC_END = "19970601000000", "19981231235959"

ORDERS_SPEC = TableSpec(primary_keys=ORDERS_KEYS, ordering=ORDERS_ORDER,
                        partition_field="o_orderdate", partition_unit="YEAR")
ORDERS_LOAD = LoadSpec(audit_column="o_orderdate")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, table))


def orders_snapshot(orders: DataFrame) -> DataFrame:
    """Merge target: latest order per customer before 1998."""
    return latest_by_agg(orders.where(F.col("o_orderdate") < F.lit(SNAPSHOT_BEFORE).cast("timestamp_ntz")),
                         ORDERS_KEYS, ORDERS_ORDER)


def orders_with_nulls(orders: DataFrame) -> DataFrame:
    """NULL keys (% 7), NULL order values (% 11), NULL update values (% 13)."""
    k = F.col("o_orderkey")
    return orders.select(
        "o_orderkey",
        F.when(k % 7 == 0, None).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.when(k % 13 == 0, None).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(k % 11 == 0, None).otherwise(F.col("o_orderdate")).alias("o_orderdate"),
        "o_orderpriority")


def orders_as_text(orders: DataFrame, keep: tuple = ()) -> DataFrame:
    """All-string raw: 'NULL' where key % 7 = 0, 'bad' in the price where % 11 = 0.
    ``keep`` names extra columns (e.g. a directory key) passed through unchanged."""
    k = F.col("o_orderkey")

    def txt(c):
        return F.when(k % 7 == 0, F.lit("NULL")).otherwise(F.col(c).cast("string"))
    price = F.when(k % 7 == 0, F.lit("NULL")).when(k % 11 == 0, F.lit("bad")) \
        .otherwise(F.col("o_totalprice").cast("string"))
    return orders.select(k.cast("string").alias("o_orderkey"), txt("o_custkey").alias("o_custkey"),
                         txt("o_orderstatus").alias("o_orderstatus"), price.alias("o_totalprice"),
                         txt("o_orderdate").alias("o_orderdate"), txt("o_orderpriority").alias("o_orderpriority"),
                         *keep)


ORDERS_SCHEMA_JSON = {"schema": [
    {"name": "o_orderkey", "dataType": "INT64"},
    {"name": "o_custkey", "dataType": "INT64"},
    {"name": "o_orderstatus", "dataType": "STRING"},
    {"name": "o_totalprice", "dataType": "FLOAT64"},
    {"name": "o_orderdate", "dataType": "DATETIME"},
    {"name": "o_orderpriority", "dataType": "STRING"},
]}


# ---------------------------------------------------------------- job catalog shapes
# customer -> jobs and job details, orders -> dependencies, nation -> servers and
# systems, region -> logic modules. The SQL twins live in registry.CATALOG_SQL.

CHAIN = "BUILDING"


def jobs(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("job_key"), F.col("c_name").alias("job_name"),
        F.col("c_nationkey").alias("application_system_key"),
        (F.col("c_nationkey") % 5).alias("logic_module_key"),
        F.when(k % 3 == 0, F.lit(15)).otherwise(F.lit(30)).alias("job_frequency_code"),
        F.when(F.col("c_acctbal") >= 0, F.lit("Y")).otherwise(F.lit("N")).alias("is_active"),
        F.when(k % 17 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("is_skip"),
        F.when(k % 19 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("is_hold"),
        F.col("c_mktsegment").alias("scheduler_chain_name"),
        F.lower("c_name").alias("scheduler_job_name"),
        F.concat(F.lit('{"catch_up": "'), F.when(k % 2 == 0, F.lit("true")).otherwise(F.lit("false")),
                 F.lit('", "owner": {"id": '), k.cast("string"), F.lit("}}")).alias("job_attributes"))


def dependencies(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").alias("job_key"), F.col("o_orderkey").alias("related_job_key"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Y")).otherwise(F.lit("N")).alias("is_active"))


def details(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("job_key"), (F.col("c_custkey") * 10).alias("data_entity_key"),
        F.col("c_nationkey").alias("source_application_server_key"),
        ((F.col("c_nationkey") + 1) % 25).alias("target_application_server_key"))


def servers(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").alias("application_server_key"),
        F.concat(F.lit('{"server": "'), F.col("n_name"), F.lit('"}')).alias("server_attributes"),
        F.when(F.col("n_nationkey") % 10 == 3, F.lit("N")).otherwise(F.lit("Y")).alias("is_active"))


def logic_modules(region: DataFrame) -> DataFrame:
    r = F.col("r_regionkey")
    return region.select(
        r.alias("logic_module_key"),
        F.when(r % 2 == 0, F.lit("spark")).otherwise(F.lit("script")).alias("logic_module_type_code"),
        F.concat(F.lit('{"runtime_in_ms_enabled": "'), F.when(r == 1, F.lit("false")).otherwise(F.lit("true")),
                 F.lit('"}')).alias("logic_body"))


def systems(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").alias("application_system_key"),
        F.concat(F.lit('{"region": '), F.col("n_regionkey").cast("string"), F.lit("}")).alias("system_attributes"),
        F.when(F.col("n_regionkey") == 4, F.lit("N")).otherwise(F.lit("Y")).alias("is_active"))


def epoch_ms(ts_ntz):
    """UTC wall clock (timestamp_ntz) -> epoch milliseconds, zone-free."""
    return F.timestamp_diff("MILLISECOND", ntz_lit("1970-01-01 00:00:00"), ts_ntz)


def run_stats(events: DataFrame) -> DataFrame:
    """events -> run history: purchase = COMMITTED, error = FAILED, else the type."""
    et = F.col("event_type")
    return events.select(
        F.col("user_id").alias("job_key"), epoch_ms(F.col("ts")).alias("job_runtime_ms"),
        F.when(et == "purchase", F.lit("COMMITTED")).when(et == "error", F.lit("FAILED"))
        .otherwise(F.upper(et)).alias("job_status_code"),
        F.col("event_id").alias("job_run_sequence"))


# ---------------------------------------------------------------- window requests
# customer -> one window request per job; events -> run history. SQL twins in
# registry (REQ_SQL, ...).

def window_requests(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    seq_max = F.when(k % 3 == 0, F.lit(1)).when(k % 3 == 1, F.lit(4)).otherwise(F.lit(48))
    return customer.select(
        k.alias("job_key"), seq_max.alias("seq_max"), ((k % seq_max) + 1).cast("int").alias("seq_num"),
        F.when(k % 2 == 0, F.lit(30)).otherwise(F.lit(60)).alias("refresh"),
        F.concat(F.lit("202401"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0")).alias("run_date"),
        F.when(k % 5 == 0, F.lit("WEEKLY")).otherwise(F.lit("DAILY")).alias("schedule"),
        F.when(k % 7 == 0, F.lit("%Y%m%d075959")).otherwise(F.lit("%Y%m%d%H%M%S")).alias("run_id_format"),
        F.when(k % 11 == 0, F.lit("20240101000000")).otherwise(F.lit("99999999999999"))
        .alias("min_run_id_to_process"))


def last_runs(grid: DataFrame) -> DataFrame:
    """Last run per job, by job key % 6: none, FAILED at seq 2, COMPLETED at seq 1,
    COMPLETED at the last id, an unknown id, a missing status."""
    from pyspark.sql import Window
    case = F.col("job_key") % 6
    n = F.max("seq").over(Window.partitionBy("job_key"))
    g = grid.withColumn("__n", n)
    pick = (F.when(case == 1, F.lit(2)).when(case == 2, F.lit(1)).when(case == 3, F.col("__n"))
            .when(case == 4, F.lit(1)).when(case == 5, F.lit(1)))
    rows = g.where(F.col("seq") == pick)
    return rows.select(
        "job_key",
        F.when(case == 1, F.lit("FAILED")).when(case.isin(2, 3, 4), F.lit("COMPLETED")).alias("status"),
        F.when(case == 4, F.lit("19000101000000")).otherwise(F.col("run_id")).alias("last_run_id"))


def split_requests(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    run_date = F.concat(F.lit("202401"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"))
    return customer.select(
        k.alias("job_key"),
        F.when(k % 4 == 0, F.lit(15)).when(k % 4 == 1, F.lit(7)).when(k % 4 == 2, F.lit(10))
        .otherwise(F.lit(60)).alias("job_frequency"),
        run_date.alias("run_date"),
        F.concat(run_date, F.lpad((k % 24).cast("string"), 2, "0"),
                 F.when(k % 2 == 0, F.lit("00")).otherwise(F.lit("30")), F.lit("00")).alias("run_datetime"),
        ((k % 48) + 1).cast("int").alias("seq_num"),
        (k % 9 == 0).alias("catch_up"))


def catch_up_requests(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("job_key"),
        F.when(F.col("event_id") % 2 == 0, F.lit(15)).otherwise(F.lit(30)).alias("job_frequency"),
        F.date_format(F.date_trunc("MINUTE", "ts"), "yyyyMMddHHmmss").alias("run_datetime"),
        F.concat(F.lit('{"catch_up": "'), F.when(F.col("user_id") % 3 == 0, F.lit("false"))
                 .otherwise(F.lit("true")), F.lit('"}')).alias("job_attributes"))


def committed_runs(events: DataFrame) -> DataFrame:
    from ..operators.windows import local_epoch_seconds
    end = F.timestamp_add("MINUTE", F.lit(15), F.date_trunc("MINUTE", "ts").cast("timestamp_ntz"))
    return events.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("job_key"), (local_epoch_seconds(end) * 1000).alias("job_runtime_ms"),
        F.lit("COMMITTED").alias("job_status_code"))


def validation_requests(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("job_key"), (k % 50).cast("int").alias("seq_num"), F.lit(48).alias("seq_max"),
        F.when(k % 4 == 0, F.lit("20240115")).when(k % 4 == 1, F.lit("20240230"))
        .when(k % 4 == 2, F.lit("20250101")).otherwise(F.lit("2024011")).alias("run_date"))


# ---------------------------------------------------------------- job statistics
# lineitem -> one job per row with a two-stage plan built from the row itself
# (no grouping): an Input stage reading part_<partkey> and an Aggregate stage.

def job_statistics(lineitem: DataFrame) -> DataFrame:
    k, ln, p, s = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    start = epoch_ms(F.col("l_shipdate"))
    end = start + (F.col("l_quantity") * 1000).cast("bigint")
    reads = (F.when(p % 7 == 0, F.array(F.lit("$1"), F.lit("FROM")))
             .when(p % 7 == 1, F.array(F.lit("$1:l_orderkey")))
             .otherwise(F.array(F.lit("$1:l_orderkey"), F.concat(F.lit("FROM part_"), p.cast("string")))))
    step = "struct<kind:string,substeps:array<string>>"
    stage0 = F.struct(F.lit("S00: Input").alias("name"), start.alias("startMs"), (start + 500).alias("endMs"),
                      F.col("l_quantity").cast("bigint").alias("recordsRead"),
                      F.array().cast("array<string>").alias("inputStages"),
                      F.array(F.struct(F.lit("READ").alias("kind"), reads.alias("substeps")),
                              F.struct(F.lit("WRITE").alias("kind"),
                                       F.array(F.lit("__stage00_output")).alias("substeps"))).alias("steps"))
    stage1 = F.struct(F.lit("S01: Aggregate").alias("name"), (start + 500).alias("startMs"), end.alias("endMs"),
                      ln.cast("bigint").alias("recordsRead"), F.array(F.lit("S00")).alias("inputStages"),
                      F.array(F.struct(F.lit("COMPUTE").alias("kind"),
                                       F.array(F.concat(F.lit("$"), s.cast("string")), F.lit("sum($2)"))
                                       .alias("substeps")),
                              F.struct(F.lit("WRITE").alias("kind"),
                                       F.array(F.lit("__stage01_output")).alias("substeps"))).alias("steps"))
    plan = F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.array(stage0, stage1))
    return lineitem.select(
        F.concat_ws("_", F.lit("job"), k.cast("string"), ln.cast("string"), p.cast("string"), s.cast("string"))
        .alias("job_id"),
        F.when(ln > 1, F.concat(F.lit("script_"), k.cast("string"))).alias("parent_job_id"),
        F.concat(F.lit("MERGE INTO snapshot_"), (p % 50).cast("string"), F.lit(" USING raw_"), s.cast("string"),
                 F.lit(" "), F.repeat(F.lit("x"), (F.col("l_extendedprice").cast("int") % 5000))).alias("query"),
        F.struct(start.alias("startTime"), end.alias("endTime"),
                 F.struct(F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("bigint").cast("string"))
                          .alias("numDmlAffectedRows"), plan.alias("queryPlan")).alias("query")).alias("statistics"),
        F.when(F.col("l_discount") > 0.05, F.struct(F.lit("raw_tables").alias("datasetId"),
                                                     F.concat(F.lit("snapshot_"), (p % 50).cast("string"))
                                                     .alias("tableId"))).alias("destination"),
        F.struct(F.date_format("l_shipdate", "yyyyMMddHHmmss").alias("end_time_ms"), ln.alias("seq_num"),
                 F.concat(F.lit("job_"), (s % 10).cast("string")).alias("job_name")).alias("params"))


# ---------------------------------------------------------------- layered attributes
# part -> entity = partkey div 6, layer = partkey % 6, one JSON document per row.

def layered_attributes(part: DataFrame, conflicts: bool = False) -> DataFrame:
    k = F.col("p_partkey")
    b, t, s = F.col("p_brand"), F.col("p_type"), F.col("p_size").cast("string")
    layer = (k % 6).cast("int")
    last = F.concat(F.lit('{"size_class": "'), F.when(F.col("p_size") > 25, F.lit("L")).otherwise(F.lit("S")),
                    F.lit('"}'))
    if conflicts:
        last = F.when(F.col("p_size") > 40, F.lit('{"spec": "flat"}')).otherwise(last)
    doc = (F.when(layer == 0, F.concat(F.lit('{"brand": "'), b, F.lit('", "spec": {"type": "'), t,
                                       F.lit('", "size": '), s, F.lit("}}")))
           .when(layer == 1, F.concat(F.lit('{"brand": "'), b, F.lit('"}')))
           .when(layer == 2, F.concat(F.lit('{"spec": {"size": '), s, F.lit("}}")))
           .when(layer == 3, F.concat(F.lit('{"brand": "'), b, F.lit('", "tags": ['), s, F.lit(", "), s,
                                      F.lit("]}")))
           .when(layer == 4, F.concat(F.lit('{"spec": {"type": "'), t, F.lit('"}}')))
           .otherwise(last))
    return part.select(F.floor(k / 6).alias("entity"), layer.alias("layer"), doc.alias("attributes"))


def odd_attributes(part: DataFrame) -> DataFrame:
    """Documents with texts that look like objects, dotted keys, empty objects and 3 or 12 levels."""
    b, size = F.col("p_brand"), F.col("p_size").cast("string")
    low = F.concat(F.lit('{"text": "{'), b, F.lit('}", "dot.ted": '), size,
                   F.lit(', "dot": {"ted": 0}, "bare": {}, "filled": {}}'))

    def nested(depth: int):
        opened = "".join(f'"n": {i}, "k{i + 1}": ' + ("{" if i + 1 < depth else "") for i in range(depth))
        return F.concat(F.lit('{"filled": {"x": ["'), b, F.lit('"]}, ' + opened + '"'), b, F.lit('"' + "}" * depth))
    high = F.when(F.col("p_partkey") % 2 == 0, nested(12)).otherwise(nested(3))
    docs = F.explode(F.array(F.struct(F.lit(0).alias("layer"), low.alias("attributes")),
                             F.struct(F.lit(1).alias("layer"), high.alias("attributes"))))
    return part.select(F.col("p_partkey").alias("entity"), docs.alias("d")).select("entity", "d.layer", "d.attributes")


def repeated_keys(part: DataFrame) -> DataFrame:
    """Documents that give keys twice; every fifth entity's second layer is cut off, the others' is empty."""
    size, fifth = F.col("p_size").cast("string"), F.col("p_partkey") % 5 == 0
    low = F.concat(F.lit('{"a": "first", "a": '), size, F.when(fifth, "").otherwise(
        F.concat(F.lit(', "b": {"c": 1}, "b": {"d": "'), F.col("p_type"), F.lit('"}'))), F.lit("}"))
    high = F.when(fifth, F.concat(F.lit('{"a": '), size)).otherwise("{}")
    docs = F.explode(F.array(F.struct(F.lit(0).alias("layer"), low.alias("attributes")),
                             F.struct(F.lit(1).alias("layer"), high.alias("attributes"))))
    return part.select(F.col("p_partkey").alias("entity"), docs.alias("d")).select("entity", "d.layer", "d.attributes")

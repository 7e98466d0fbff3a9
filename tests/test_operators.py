import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from result_rows import rows
from lakeload.functions import scalars
from lakeload.operators import audit, jobstats, layers, project, retention, windows
from lakeload.session import scratch_dir
from lakeload.sinks import tables as sinks
from lakeload.sources import connectors, files, inventory
from lakeload.spec import TableSpec, spark_type

D = dt.datetime


# ---------------------------------------------------------------- spec / projections

def test_type_map_and_config():
    assert spark_type("INT64") == "bigint" and spark_type("my_blob_x".upper()) == "binary"
    assert spark_type("STRUCT<a STRING, b INT64>") == "struct<a string, b bigint>"
    spec = TableSpec.from_config({"PRIMARY_KEYS": "a, b", "ORDERING_COLUMNS": "x; y",
                                  "DATA": {"PARTITION_FIELD": "ts", "PARTITION_TYPE": "MONTH"},
                                  "ERROR_IF_PARTITION_COLUMN_HAS_NULL": "False"},
                                 {"DO_NOT_UPDATE_COLUMNS": "created, load_id"})
    assert spec.primary_keys == ("a", "b") and spec.ordering == ("x", "y")
    assert spec.null_partition == "allow" and spec.never_update == ("created", "load_id")
    assert spec.dedup == "agg"
    assert TableSpec.from_config({"PRIMARY_KEYS": "a"}, query_type="ROW_NUM").dedup == "window"
    assert TableSpec.from_config({"PRIMARY_KEYS": "a"}, query_type="OTHER").dedup == "agg"  # fallback


def test_safe_cast_and_null_literal(spark):
    df = spark.createDataFrame([("1", "NULL", "2.5", "null"), ("x", "abc", "bad", "NULL")], "a string, b string, c string, d string")
    schema = {"schema": [{"name": "a", "dataType": "INT64"}, {"name": "b", "dataType": "STRING"},
                         {"name": "c", "dataType": "FLOAT64"}, {"name": "d", "dataType": "MY_BLOB"}]}
    out = project.safe_cast_all(df, schema)
    assert rows(out) == sorted([(1, None, 2.5, bytearray(b"null")), (None, "abc", None, None)], key=repr)
    json_path = project.safe_cast_all(df, schema, null_marker=False, only_non_text=True)
    assert rows(json_path, "b") == [("NULL",), ("abc",)]  # JSON path: STRING columns untouched


def test_clean_names_audit_order_and_strict_cast(spark):
    df = spark.createDataFrame([(1, "x")], "`order key` int, `select` string")
    assert project.clean_names(df).columns == ["order_key", "select"]
    base = spark.createDataFrame([(1, D(2024, 1, 1))], "a int, last_ingestion_utc_time timestamp_ntz")
    csv = project.add_audit_columns(base, ["a + 1 AS b", ""], "PST8PDT")
    assert csv.columns == ["a", "last_ingestion_utc_time", "b", "source_timezone"]
    js = project.add_audit_columns(base, ["a + 1 AS b"], "PST8PDT", layout="json")
    assert js.columns == ["a", "b", "source_timezone", "last_ingestion_utc_time"]
    bad = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception):
        project.strict_cast(bad, {"a": "INT64"}).collect()


def test_filter_window_inclusive_bounds_in_zone(spark):
    # 20240115000000 .. 20240115235959 in PST8PDT = 08:00:00 .. next day 07:59:59 UTC
    df = spark.createDataFrame([(D(2024, 1, 15, 7, 59, 59),), (D(2024, 1, 15, 8),), (D(2024, 1, 16, 7, 59, 59),),
                                (D(2024, 1, 16, 8),)], "t timestamp_ntz")
    out = project.filter_window(df, "t", "20240115000000", "20240115235959")
    assert rows(out) == [(D(2024, 1, 15, 8),), (D(2024, 1, 16, 7, 59, 59),)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "to_timestamp" not in plan.lower()  # bounds folded to literals


def test_drop_fields_recursive_keeps_nulls_and_lists(spark):
    df = spark.createDataFrame(
        [({"a": 1, "drop": 2, "inner": {"drop": 3, "b": 4}, "items": [{"drop": 5, "c": 6}]}, 9),
         (None, 8)],
        "s struct<a:int,drop:int,inner:struct<drop:int,b:int>,items:array<struct<drop:int,c:int>>>, drop int")
    out = project.drop_fields_recursive(df, ["drop"])
    assert out.schema.simpleString() == \
        "struct<s:struct<a:int,inner:struct<b:int>,items:array<struct<drop:int,c:int>>>>"
    assert rows(out.select(F.col("s").isNull().alias("n")), "n") == [(False,), (True,)]


# ---------------------------------------------------------------- scalars

def test_run_id_conversions_and_daylight_cases(spark):
    df = spark.createDataFrame([("20240115120000",), ("20240715120000",), ("20240310023000",), ("20241103013000",)],
                               "r string")
    out = df.select("r", scalars.run_id_to_epoch_ms("r").alias("ms"))
    got = {r["r"]: int(r["ms"]) for r in out.collect()}
    utc = dt.timezone.utc
    assert got["20240115120000"] == int(D(2024, 1, 15, 20, tzinfo=utc).timestamp() * 1000)  # PST
    assert got["20240715120000"] == int(D(2024, 7, 15, 19, tzinfo=utc).timestamp() * 1000)  # PDT
    assert got["20240310023000"] == int(D(2024, 3, 10, 9, 30, tzinfo=utc).timestamp() * 1000)  # gap: daylight
    fwd = df.select("r", scalars.run_id_to_epoch_ms("r", gap="forward").alias("ms"))
    assert {r["r"]: int(r["ms"]) for r in fwd.collect()}["20240310023000"] == \
        int(D(2024, 3, 10, 10, 30, tzinfo=utc).timestamp() * 1000)  # Java rule: forward
    assert got["20241103013000"] == int(D(2024, 11, 3, 8, 30, tzinfo=utc).timestamp() * 1000)  # repeat: daylight
    back = out.select("r", scalars.epoch_ms_to_run_id(F.col("ms").cast("bigint"), "PST8PDT").alias("b"))
    assert {r["r"]: r["b"] for r in back.collect()}["20240715120000"] == "20240715120000"
    e = spark.createDataFrame([(1705320000999,)], "ms bigint").select(scalars.epoch_ms_to_run_id("ms").alias("x"))
    assert e.first()["x"] == "20240115120000"  # UTC, fraction dropped


def test_sequences_json_and_names(spark):
    df = spark.createDataFrame([(D(2024, 1, 1, 0, 0),), (D(2024, 1, 1, 0, 30),), (D(2024, 1, 1, 23, 59),)],
                               "t timestamp_ntz")
    out = df.select(scalars.run_sequence("t", 30).alias("s30"), scalars.run_sequence("t", 7).alias("s7"))
    assert rows(out) == [(1, 1), (2, 5), (48, None)]  # 7 does not divide 1440: NULL at the day's end
    j = spark.createDataFrame([('{"a": {"b": "x"}, "c": 1}',)], "j string")
    got = j.select(scalars.json_attr("j", "a.b", "d").alias("ab"), scalars.json_attr("j", ["z"], "d").alias("z"))
    assert got.first() == ("x", "d")
    n = spark.createDataFrame([("PAYMENT_SOURCE__DETAIL",)], "t string")
    assert n.select(scalars.short_name("t", 2)).first()[0] == "paso" + "de"
    lab = n.select(scalars.job_labels("t", F.lit("snapshot"), F.lit("ds"), F.lit("20240131235959"), F.lit(3),
                                      "20240201000000").alias("l")).select("l.*").first()
    assert lab["job_instance_id"] == "-s-psd-240131235959-3" and lab["billing_tag"] == "-snapshot-pasode-240131235959"
    c = spark.createDataFrame([("abc",)], "t string").select(scalars.checksum("t")).first()[0]
    assert c == 891568578  # zlib.crc32(b"abc")


# ---------------------------------------------------------------- sources / sinks

def test_delimited_headers_jagged_rows_and_keys(spark):
    d = scratch_dir(spark, "t_csv")
    df = spark.createDataFrame([(str(i), f"v{i}") for i in range(50)], "a string, b string").repartition(3)
    sinks.write_delimited(df, d, "|", header_rows=2)
    schema = [("a", "INT64"), ("b", "STRING")]
    out = files.scan_delimited(spark, d, schema, "|", header_rows=2)
    assert out.count() == 50 and out.where(F.col("a") == "a").count() == 0
    bad = scratch_dir(spark, "t_bad")
    spark.createDataFrame([("1|x",), ("2",)], "value string").write.text(bad)
    with pytest.raises(Exception):
        files.scan_delimited(spark, bad, schema, "|").collect()
    keyed = scratch_dir(spark, "t_keys")
    spark.createDataFrame([("1|x", "2024-01-02")], "value string, day string").write.partitionBy("day").text(keyed)
    k = files.scan_delimited(spark, keyed, schema, "|", keys={"day": "DATE"})
    assert dict(k.dtypes)["day"] == "date" and k.first()["day"] == dt.date(2024, 1, 2)


def test_bind_params_and_jdbc_options():
    q = connectors.bind_params("SELECT * FROM t WHERE a = :a AND b = :b", {"a": "x'y", "b": 3})
    assert q == "SELECT * FROM t WHERE a = 'x''y' AND b = 3"
    opts = connectors.jdbc_options("jdbc:x", "SELECT 1", partition_column="id", lower=0, upper=10, num_partitions=4)
    assert opts["dbtable"] == "(SELECT 1) q" and opts["numPartitions"] == "4"


def test_inventory_and_retention(spark, tmp_path):
    root = tmp_path / "data"
    (root / "sub").mkdir(parents=True)
    now = D(2024, 6, 1).timestamp()
    for rel, age_days in [("a_dly.txt", 20), ("b_dly.txt", 2), ("sub/c_dly.txt", 30), ("connection_pool_dly.txt", 30),
                          ("x.log", 30)]:
        p = root / rel
        p.write_text("x")
        os.utime(p, (now - age_days * 86400, now - age_days * 86400))
    inv = inventory.file_inventory(spark, str(root))
    assert inv.count() == 5
    plain = {"_dly.txt": {"directories": [str(root)], "recursive_directories": [], "retention_days": 10}}
    got = retention.retention_candidates(inv, retention.rules_frame(spark, plain), D(2024, 6, 1))
    assert [os.path.basename(r[0]) for r in rows(got)] == ["a_dly.txt"]
    rec = {"_dly.txt": {"directories": [], "recursive_directories": [str(root)], "retention_days": 10}}
    got = retention.retention_candidates(inv, retention.rules_frame(spark, rec), D(2024, 6, 1))
    assert sorted(os.path.basename(r[0]) for r in rows(got)) == ["a_dly.txt", "c_dly.txt"]
    assert (root / "a_dly.txt").exists()  # listed only, never deleted
    folders = inventory.distinct_folders(inv)
    assert folders.count() == 2


def test_schema_evolution_and_add_columns(spark):
    d = scratch_dir(spark, "t_evolve")
    sinks.append_raw(spark.createDataFrame([(1, (1, "a"))], "id int, s struct<x:int,y:string>"), d)
    sinks.append_with_new_fields(spark.createDataFrame([(2, (2, "b", 3.0), "n")],
                                                       "id int, s struct<x:int,y:string,z:double>, extra string"), d)
    out = sinks.read_evolved(spark, d)
    assert rows(out.select("id", "s.z", "extra")) == [(1, None, None), (2, 3.0, "n")]
    name = "t_add_cols"
    spark.createDataFrame([(1,)], "a int").write.option("path", scratch_dir(spark, "t_add")).saveAsTable(name)
    assert sinks.add_columns(spark, name, {"b": "STRING"}).columns == ["a", "b"]
    assert sinks.table_exists(spark, name)


# ---------------------------------------------------------------- audit

def test_audit_counts_null_tuples_and_keyless(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (None, 2), (2, 3)], "a int, b int")
    assert audit.distinct_key_count(df, ["a", "b"]).first()[0] == 4  # NULL-bearing tuples count
    assert audit.null_key_count(df, ["a", "b"]).first()[0] == 1
    rep = audit.audit_tables([audit.AuditTable("t", df, df.limit(2), ["a", "b"], F.col("a") == 1),
                              audit.AuditTable("keyless", df, None, [""])]).collect()
    t, k = sorted(rep, key=lambda r: r["table_name"])[::-1]
    assert (t["raw_total_count"], t["raw_history_count"], t["raw_distinct_primary_key_count"],
            t["raw_primary_key_null_count"], t["table_type"]) == (5, 2, 4, 1, "RAW_AND_SNAPSHOT")
    assert (k["raw_distinct_primary_key_count"], k["table_type"]) == (0, "RAW_ONLY")
    assert audit.scalar(df.limit(0), "a").first()[0] == "0"


# ---------------------------------------------------------------- windows

def req(spark, data):
    return spark.createDataFrame(data, "job_key bigint, seq_max int, seq_num int, refresh int, run_date string, "
                                       "schedule string, run_id_format string")


def test_window_grid_daily_weekly_and_fixed_format(spark):
    g = windows.window_grid(req(spark, [(1, 1, 1, 30, "20240115", "DAILY", None),
                                        (2, 2, 2, 60, "20240115", "WEEKLY", None),
                                        (3, 1, 1, 1440, "20240115", "DAILY", "%Y%m%d075959")]))
    one = [r["run_id"] for r in g.where("job_key = 1").orderBy("seq").collect()]
    assert len(one) == 48 and one[0] == "20240115002959" and one[-1] == "20240115235959"
    two = [r["run_id"] for r in g.where("job_key = 2").orderBy("seq").collect()]
    assert len(two) == 84 and two[0] == "20240115125959"  # weekly count, one-day offset (T16)
    assert [r["run_id"] for r in g.where("job_key = 3").collect()] == ["20240115075959"]


def test_current_and_pending_windows(spark):
    g = windows.window_grid(req(spark, [(k, 1 if k == 9 else 4, 1, 60, "20240115", "DAILY", None)
                                        for k in range(1, 10)]))
    cur = windows.current_window(g, "20240115033000")
    assert [r["run_id"] for r in cur.where("job_key = 9").collect()] == ["20240115025959"]
    ids = [f"20240115{h:02d}5959" for h in range(6)]
    last = spark.createDataFrame([(2, "FAILED", ids[2]), (3, "COMPLETED", ids[2]), (4, "COMPLETED", ids[5]),
                                  (5, "RUNNING", ids[1]), (6, "COMPLETED", "19000101000000"), (7, None, ids[1])],
                                 "job_key bigint, status string, last_run_id string")
    out = {}
    for r in windows.pending_windows(cur.where("job_key <= 7"), last).collect():
        out.setdefault(r["job_key"], []).append((r["run_id"], r["rerun_indicator"], r["status"]))
    assert len(out[1]) == 6
    assert sorted(out[2]) == [(ids[i], "Y", "PENDING") for i in range(2, 6)]
    assert sorted(out[3]) == [(ids[i], "N", "PENDING") for i in range(3, 6)]
    assert out[4] == [(None, "N", "DONE")]
    assert out[5] == [(None, "N", "ERROR_UNKNOWN_STATUS")]
    assert out[6] == [(None, "N", "ERROR_UNKNOWN_LAST_RUN_ID")]
    assert out[7] == [(None, "N", "ERROR_MISSING_STATUS_OR_RUN_ID")]


def test_split_validate_and_attributes(spark):
    runs = spark.createDataFrame([(1, 10, "20240115", "20240115013000", 4), (2, 7, "20240115", "20240115013000", 4),
                                  (3, 60, "20240115", "20240115013000", 4)],
                                 "job_key bigint, job_frequency int, run_date string, run_datetime string, seq_num int")
    sp = windows.split_windows(runs, 30)
    assert [(r["sub_run_datetime"], r["sub_seq"]) for r in sp.where("job_key = 1").orderBy("sub_seq").collect()] == \
        [("20240115013000", 10), ("20240115014000", 11), ("20240115015000", 12)]
    assert sp.where("job_key = 2").first()["status"] == "ERROR_FREQUENCY"
    assert sp.where("job_key = 3").first()["sub_seq"] == 4
    v = spark.createDataFrame([(5, 4, "20240101"), (1, 4, "20240230"), (1, 4, "20240201"), (1, 4, "20240120")],
                              "seq_num int, seq_max int, run_date string")
    got = [(r["status"], r["catchup"]) for r in windows.validate_requests(v, "20240120").collect()]
    assert got == [("ERROR_SEQ_NUM", None), ("ERROR_RUN_DATE", None), ("ERROR_FUTURE_RUN_DATE", None), ("OK", False)]


# ---------------------------------------------------------------- statistics, layers

def test_job_and_stage_stats(spark):
    schema = ("job_id string, parent_job_id string, query string, statistics struct<startTime:bigint,endTime:bigint,"
              "query:struct<numDmlAffectedRows:string,queryPlan:array<struct<name:string,startMs:bigint,endMs:bigint,"
              "recordsRead:bigint,inputStages:array<string>,steps:array<struct<kind:string,substeps:array<string>>>>>>>,"
              " destination struct<datasetId:string,tableId:string>, params struct<end_time_ms:string,seq_num:int,"
              "job_name:string>")
    plan = [("S00: Input", 0, 1500, 10, [], [("READ", ["$1", "FROM ds.tbl"]), ("READ", ["$2"])]),
            ("S01: Join", 1500, 2000, 5, ["S00"], [("JOIN", ["a", "b"]), ("WRITE", ["out"])])]
    data = [("p", None, "q" * 5000, (1000, 4000, (None, plan)), ("ds", "t"), ("20240115000000", 1, "job")),
            ("c", "p", "child", (0, 500, ("7", None)), None, ("20240115000000", 1, "job"))]
    df = spark.createDataFrame(data, schema)
    js = {r["job_id"]: r for r in jobstats.job_stats(df).collect()}
    assert js["p"]["db_name"] == "ds:t" and js["p"]["record_count"] == "0" and len(js["p"]["query"]) == 4000
    assert js["p"]["time_taken"] == 3.0 and js["p:c"]["db_name"] == "NO_TARGET_SPECIFIED"
    st = sorted(jobstats.stage_stats(df).collect(), key=lambda r: r["init_time"])
    assert st[0]["query"] == "$1, FROM ds.tbl__::__$2" and st[0]["db_name"] == "ds.tbl__::__$2"
    assert st[1]["query"] == "JOIN:a, b__::__ WRITE:out" and st[1]["db_name"] == "Input stage : S00"
    assert jobstats.all_stats(df).count() == 4


def test_layers_resolve_and_conflicts(spark):
    docs = [(1, 0, json.dumps({"a": {"x": 1, "y": 2}, "l": [1, 2]})), (1, 3, json.dumps({"a": {"x": 9}, "l": [3]})),
            (2, 0, json.dumps({"a": {"x": 1}})), (2, 4, json.dumps({"a": "flat"}))]
    attrs = spark.createDataFrame(docs, "entity int, layer int, attributes string")
    got = {(r["entity"], ".".join(r["path"])): r["value"] for r in layers.resolve_layers(attrs).collect()}
    assert got[(1, "a.x")] == "9" and got[(1, "a.y")] == "2" and got[(1, "l")] == "[3]"
    conf = layers.layer_conflicts(attrs).collect()
    assert [(r["entity"], r["path"]) for r in conf] == [(2, ["a"])]
    assert layers.layer_rank(F.lit("job")) is not None


def test_layers_of_odd_documents(spark):
    deep = 1
    for i in range(12, 0, -1):
        deep = {f"k{i}": deep, "s": i}
    docs = [(1, 0, '{"a":"{x}","b":1}'), (2, 0, '{"c":{},"b":1}'), (3, 0, '{"a.b":1,"a":{"b":2}}'), (4, 0, json.dumps(deep)),
            (5, 0, '{"c":{}}'), (5, 1, '{"c":{"x":[1, {"y":2}]}}'), (6, 0, None), (7, 0, "[1]"), (8, 0, "{}")]
    attrs = spark.createDataFrame(docs, "entity int, layer int, attributes string")
    got = {}
    for r in layers.resolve_layers(attrs).collect():
        got.setdefault(r["entity"], {})[tuple(r["path"])] = r["value"]
    assert got[1] == {("a",): "{x}", ("b",): "1"}
    assert got[2] == {("c",): "{}", ("b",): "1"}
    assert got[3] == {("a.b",): "1", ("a", "b"): "2"}
    keys = [f"k{i}" for i in range(1, 13)]
    assert got[4] == {tuple(keys[:i] + ["s"]): str(i + 1) for i in range(12)} | {tuple(keys): "1"}
    assert got[5] == {("c", "x"): '[1,{"y":2}]'}
    assert set(got) == {1, 2, 3, 4, 5}


def test_layers_of_documents_with_repeated_keys_and_of_no_json(spark):
    docs = [(1, 0, '{"a":1,"a":2,"b":{"c":1},"b":{"d":1.50}}'), (1, 1, '{"a":'), (2, 0, '{"x":NaN}'), (2, 3, "nothing"), (3, 0, '{"x":null,"y":[1e3,{"b":1,"a":"é\\ud800"}]}'),
            (4, 0, '{"x":{}}'), (4, 1, '{"x":1}'), (4, 2, '{"x":{}}'), (5, 0, '{"x":{"y":1}}'), (5, 2, '{"x":{}}')]
    attrs = spark.createDataFrame(docs, "entity int, layer int, attributes string")
    got = {(r["entity"], "/".join(r["path"])): (r["value"], r["layer"]) for r in layers.resolve_layers(attrs).collect()}
    assert got == {(1, "a"): ("2", 0), (1, "b/d"): ("1.50", 0), (3, "x"): (None, 0), (3, "y"): ('[1e3,{"a":"é?","b":1}]', 0),
                   (4, "x"): ("{}", 2), (5, "x/y"): ("1", 0)}
    errors = {(r["entity"], "/".join(r["path"])): r["error"] for r in layers.layer_conflicts(attrs).collect()}
    assert errors == {(1, ""): "no JSON document in layer 1", (2, ""): "no JSON document in layer 0, 3",
                      (4, "x"): "layers disagree whether this key is an object: x"}


def test_resolving_layers_is_one_job_whatever_the_depth(spark):
    deep = 1
    for i in range(40, 0, -1):
        deep = {f"k{i}": deep}
    attrs = spark.createDataFrame([(1, 0, json.dumps(deep))], "entity int, layer int, attributes string")
    plan = layers.resolve_layers(attrs)
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert rows(plan, "path") == [([f"k{i}" for i in range(1, 41)],)]


def test_paths_of_layers_are_neither_sorted_nor_held_before_the_shuffle(spark):
    docs = [(i, j, json.dumps({"a": {f"k{n}": n * j for n in range(20)}, "b": [i]})) for i in range(300) for j in range(3)]
    attrs = spark.createDataFrame(docs, "entity int, layer int, attributes string").coalesce(1)
    for resolved in (layers.resolve_layers(attrs), layers.layer_conflicts(attrs)):
        after, before = resolved._jdf.queryExecution().executedPlan().toString().split("Exchange")
        assert "Sort" not in before and "Aggregate" not in before and "Aggregate" in after
        assert resolved.rdd.getNumPartitions() >= layers.PARTITIONS
    got = layers.resolve_layers(attrs)
    assert got.count() == 300 * 21 and got.where("path[0] = 'a' AND value = cast(2 * cast(substr(path[1], 2) AS int) AS string) AND layer = 2").count() == 300 * 20


def test_header_rows_with_files_split_across_tasks(spark):
    d = scratch_dir(spark, "t_split")
    df = spark.createDataFrame([(str(i), "x" * 20) for i in range(400)], "a string, b string").repartition(2)
    sinks.write_delimited(df, d, ",", header_rows=3, header_text="a,b")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        out = files.scan_delimited(spark, d, [("a", "INT64"), ("b", "STRING")], ",", header_rows=3)
        assert out.rdd.getNumPartitions() > 4  # files are split over several tasks
        got = sorted(int(r["a"]) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(range(400))


def test_stream_landing_batch_replay_is_idempotent(spark):
    from lakeload.streaming.landing import land_batch
    raw = scratch_dir(spark, "t_stream_raw")
    lines = spark.createDataFrame([("h", "f1", 0, D(2024, 1, 1)), ("1|a", "f1", 0, D(2024, 1, 1)),
                                   ("2|b", "f1", 0, D(2024, 1, 1))],
                                  "value string, __file string, __block bigint, last_ingestion_utc_time timestamp_ntz"
                                  ).coalesce(1)  # one file's first split is read by one task, in order
    schema = [("id", "INT64"), ("name", "STRING")]
    for _ in range(2):  # the same batch twice: the second run replaces the first
        land_batch(lines, "s-7", raw, schema, "|", 1, ["upper(name) AS up"], "PST8PDT", None, None)
    out = spark.read.parquet(raw)
    assert rows(out, "id", "up", "load_batch") == [(1, "A", "s-7"), (2, "B", "s-7")]


def test_two_streams_into_one_raw_path_keep_all_rows(spark, tmp_path):
    from lakeload.streaming.landing import land_files_stream
    raw, schema = scratch_dir(spark, "t_two_raw"), [("id", "INT64"), ("name", "STRING")]

    def land(name, ids):
        (tmp_path / name).mkdir(exist_ok=True)
        (tmp_path / name / f"{min(ids)}.txt").write_text("id|name\nx|y\n\n" + "".join(f"{i}|n{i}\n" for i in ids))
        land_files_stream(spark, str(tmp_path / name), raw, f"{tmp_path}/{name}_ckpt", schema, "|", header_rows=2).awaitTermination()
    land("one", range(10))
    land("two", range(10, 17))
    land("one", range(20, 23))
    assert rows(spark.read.parquet(raw), "id") == [(i,) for i in sorted(map(str, [*range(17), 20, 21, 22]))] or \
        sorted(r["id"] for r in spark.read.parquet(raw).collect()) == [*range(17), 20, 21, 22]


@pytest.mark.parametrize("header_rows", [0, 1, 2, 3])
def test_blank_lines_are_skipped_whatever_the_header(spark, tmp_path, header_rows):
    (tmp_path / "f.txt").write_text("".join(f"h{i}|x\n" for i in range(header_rows)) + "1|a\n\n2|b\n   \n3|c\n")
    out = files.scan_delimited(spark, str(tmp_path), [("id", "INT64"), ("name", "STRING")], "|", header_rows)
    assert rows(out) == [("1", "a"), ("2", "b"), ("3", "c")]
    if header_rows > 1:
        mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
        assert out._jdf.queryExecution().explainString(mode).count("FileScan text") == 1


def test_appends_may_add_fields_but_not_change_types(spark):
    d = scratch_dir(spark, "t_additive")
    first = spark.createDataFrame([(1, (1, [("p",)]))], "id bigint, s struct<x:int,l:array<struct<p:string>>>")
    sinks.append_with_new_fields(first, d)
    for bad in ("id string, s struct<x:int,l:array<struct<p:string>>>", "id bigint, s struct<x:string,l:array<struct<p:string>>>",
                "id bigint, s struct<x:int,l:array<struct<p:int>>>", "id bigint, s int"):
        with pytest.raises(ValueError, match="in the table and"):
            sinks.append_with_new_struct_fields(spark.createDataFrame([], bad), d)
    more = spark.createDataFrame([(2, (2, [("q", 5)], "n"))], "id bigint, s struct<x:int,l:array<struct<p:string,w:int>>,y:string>")
    sinks.append_with_new_struct_fields(more, d)
    sinks.append_with_new_fields(spark.createDataFrame([(3, "e")], "id bigint, extra string"), d)
    out = sinks.read_evolved(spark, d)
    assert rows(out.select("id", "s.y", F.col("s.l").getItem(0)["w"].alias("w"), "extra")) == [(1, None, None, None), (2, "n", 5, None), (3, None, None, "e")]


def test_pending_windows_give_every_job_a_row(spark):
    # one id a day; jobs 1-3 ran before, 4 has an empty grid (refresh longer than its slot), 5 is new but skipped
    reqs = req(spark, [(k, 48 if k == 4 else 1, 1, 60, "20240115", "DAILY", None) for k in range(1, 6)])
    reqs = reqs.withColumn("min_run_id_to_process", F.when(F.col("job_key") == 5, F.lit("20240101000000")).otherwise(F.lit("9")))
    g = windows.current_window(windows.window_grid(reqs, keep_empty=True), "20240115120000")
    now = g.where("job_key = 1").first()["run_id"]
    assert g.where("job_key = 1").first()["seq"] > 1
    last = spark.createDataFrame([(1, "COMPLETED", now), (2, "COMPLETED", "20230101000000"), (3, "FAILED", now), (4, "COMPLETED", now)],
                                 "job_key bigint, status string, last_run_id string")
    got = sorted((r["job_key"], r["run_id"], r["status"]) for r in windows.pending_windows(g, last).collect())
    assert got == [(1, None, "DONE"), (2, None, "ERROR_UNKNOWN_LAST_RUN_ID"), (3, now, "PENDING"), (4, None, "ERROR_EMPTY_GRID"), (5, None, "SKIPPED")]


def test_texts_without_a_zone_are_utc_in_any_session(spark):
    df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-01-01T05:00:00+02:00",), ("2024-01-01 00:00:00Z",), ("2024-01-01",), ("x",)], "t string")
    want = [1710037800, 1704078000, 1704067200, 1704067200, None]
    for zone in ("UTC", "America/Los_Angeles"):
        old = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            out = project.safe_cast_all(df, [("t", "TIMESTAMP")])
            assert [r[0] for r in out.select(F.unix_seconds("t")).collect()] == want
        finally:
            spark.conf.set("spark.sql.session.timeZone", old)


def test_checksums_equal_zlib_over_all_rows(spark):
    import zlib

    from lakeload.plans import fixtures as fx
    sf = "/root/testdata/sf0.001"
    docs = fx.read(spark, sf, "documents").select("text", scalars.checksum("text").alias("c")).collect()
    assert docs and all(r["c"] == zlib.crc32(r["text"].encode()) for r in docs)
    stats = jobstats.all_stats(fx.job_statistics(fx.read(spark, sf, "lineitem")))
    seen = 0
    for r in stats.toLocalIterator():
        assert int(r["checksum"]) == zlib.crc32(r["query"].encode()) or len(r["query"]) >= 4000
        seen += 1
    assert seen == stats.count()


def test_a_connector_gets_its_query(spark, tmp_path):
    from pyspark.sql.datasource import DataSource, DataSourceReader

    class Numbers(DataSource):
        @classmethod
        def name(cls):
            return "numbers_by_query"

        def schema(self):
            return "n int, q string"

        def reader(self, schema):
            return Reader(self.options)

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.options = options

        def read(self, partition):
            for n in range(int(self.options["query"].split()[-1])):
                yield n, self.options["query"]
    spark.dataSource.register(Numbers)
    out = connectors.scan_connector(spark, "numbers_by_query", {}, "SELECT n FROM numbers LIMIT 3", takes_query=True)
    assert rows(out, "n") == [(0,), (1,), (2,)]


def test_retention_at_the_root(spark):
    inv = spark.createDataFrame([("file:/x_dly.txt", D(2020, 1, 1)), ("file:/a/y_dly.txt", D(2020, 1, 1))], "path string, modificationTime timestamp")
    for where, want in (("directories", ["/x_dly.txt"]), ("recursive_directories", ["/a/y_dly.txt", "/x_dly.txt"])):
        rules = retention.rules_frame(spark, {"_dly.txt": {where: ["/"], "retention_days": 1}})
        assert sorted(r["file"] for r in retention.retention_candidates(inv, rules, "2024-01-01 00:00:00").collect()) == want


def test_bound_parameters_leave_literals_and_casts_alone():
    got = connectors.bind_params("SELECT ':a', \"x:a\", '12:30:00', b::a, :a FROM t WHERE c = :b", {"a": 1, "b": "o'x"})
    assert got == "SELECT ':a', \"x:a\", '12:30:00', b::a, 1 FROM t WHERE c = 'o''x'"
    with pytest.raises(ValueError, match="num_partitions"):
        connectors.jdbc_options("jdbc:x", "SELECT 1", partition_column="id")


def test_audit_catalog_tables_and_clustering_choice(spark):
    spark.createDataFrame([(1,), (1,), (None,)], "k int").write.option(
        "path", scratch_dir(spark, "t_a_raw")).saveAsTable("aud_raw")
    spark.createDataFrame([(1,)], "k int").write.option("path", scratch_dir(spark, "t_a")).saveAsTable("aud")
    spark.createDataFrame([(5,)], "k int").write.option("path", scratch_dir(spark, "t_b_raw")).saveAsTable("solo_raw")
    rep = {r["table_name"]: r for r in audit.audit_catalog_tables(spark, [("aud", ["k"]), ("solo", ["k"])]).collect()}
    assert (rep["aud"]["raw_total_count"], rep["aud"]["raw_distinct_primary_key_count"],
            rep["aud"]["raw_primary_key_null_count"], rep["aud"]["table_type"]) == (3, 2, 1, "RAW_AND_SNAPSHOT")
    assert rep["solo"]["table_type"] == "RAW_ONLY"
    assert sinks.pick_clustering({"USE_CLUSTERING_FOR_RAW": "True", "CLUSTERING_FIELDS": "a"},
                                 {"CLUSTERING_FIELDS": "b"}) == "a"
    assert sinks.pick_clustering({"CLUSTERING_FIELDS": "a"}, {"CLUSTERING_FIELDS": "b"}) == "b"


def test_stream_landing_reads_new_files_once_with_folder_keys(spark):
    from lakeload.streaming.landing import land_files_stream
    src, raw, ckpt = (scratch_dir(spark, n) for n in ("t_st_src", "t_st_raw", "t_st_ckpt"))
    schema = [("id", "INT64"), ("name", "STRING")]
    for i, day in enumerate(["2024-01-01 00:00:00", "2024-01-02 00:00:00"]):
        batch = spark.createDataFrame([(f"{i}{j}|n{j}", day) for j in range(3)],
                                      "value string, last_ingestion_utc_time string")
        batch.coalesce(1).write.mode("append").partitionBy("last_ingestion_utc_time").text(src)
        land_files_stream(spark, src, raw, ckpt, schema, "|", folder_key="last_ingestion_utc_time").awaitTermination()
    out = spark.read.parquet(raw)
    assert out.count() == 6  # each file landed exactly once across the two runs
    assert rows(out.groupBy("last_ingestion_utc_time").count()) == [(D(2024, 1, 1), 3), (D(2024, 1, 2), 3)]


def test_query_with_params_accepts_both_parameter_marks(spark):
    df = spark.createDataFrame([("20240101000000",), ("20240201000000",)], "r string")
    a = project.query_with_params(spark, "SELECT r FROM {t} WHERE r BETWEEN @start_run_id AND @end_run_id",
                                  "20240101000000", "20240115000000", t=df)
    b = project.query_with_params(spark, "SELECT r FROM {t} WHERE r BETWEEN :start_run_id AND :end_run_id",
                                  "20240101000000", "20240115000000", t=df)
    assert rows(a) == rows(b) == [("20240101000000",)]


def test_land_ndjson_parquet_and_union_evolved(spark):
    from lakeload.plans.landing import land_ndjson, land_parquet
    src = scratch_dir(spark, "t_land_json")
    spark.createDataFrame([(1, "a", 2.5, "2024-01-01 00:00:00"), (2, "b", None, "2024-01-02 00:00:00")],
                          "id bigint, name string, score double, last_ingestion_utc_time string") \
        .write.partitionBy("last_ingestion_utc_time").json(src)
    schema = {"schema": [{"name": "id", "dataType": "INT64"}, {"name": "name", "dataType": "STRING"},
                         {"name": "score", "dataType": "FLOAT64"}]}
    raw = scratch_dir(spark, "t_land_json_raw")
    out = land_ndjson(spark, src, raw, schema, audit_exprs=["upper(name) AS up"], key_type="DATETIME")
    assert out.columns == ["id", "name", "score", "up", "source_timezone", "last_ingestion_utc_time"]
    assert rows(spark.read.parquet(raw), "id", "score", "up") == [(1, 2.5, "A"), (2, None, "B")]
    praw = scratch_dir(spark, "t_land_parquet_raw")
    psrc = scratch_dir(spark, "t_land_parquet")
    spark.createDataFrame([(1, "x", "2024-01-01")], "id int, v string, day string").write.partitionBy("day").parquet(psrc)
    land_parquet(spark, psrc, praw)
    assert rows(spark.read.parquet(praw), "id", "v") == [(1, "x")]
    old = spark.createDataFrame([(1, (1,))], "id int, s struct<a:int>")
    new = spark.createDataFrame([(2, (2, "b"), 9)], "id int, s struct<a:int,b:string>, extra int")
    both = sinks.union_evolved(old, new)
    assert rows(both.select("id", "s.b", "extra")) == [(1, None, None), (2, "b", 9)]


def test_history_marker_default(spark):
    raw = spark.createDataFrame([(1, D(2022, 1, 1)), (2, D(2023, 5, 1)), (3, D(2022, 1, 1))],
                                "k int, created_local_time timestamp_ntz")
    raw.write.option("path", scratch_dir(spark, "t_hist")).saveAsTable("hist_raw")
    rep = audit.audit_catalog_tables(spark, [("hist", ["k"])]).first()
    assert rep["raw_history_count"] == 2 and audit.history_marker(raw.drop("created_local_time")) is None


def test_audit_missing_tables_report_zeros(spark):
    rep = audit.audit_catalog_tables(spark, [("nowhere", ["k"])]).first()
    assert (rep["raw_total_count"], rep["snapshot_total_count"], rep["table_type"]) == (0, 0, "RAW_ONLY")


def test_sql_functions_match_column_functions(spark):
    from lakeload.functions.sql import register_sql_functions
    from lakeload.plans import fixtures as fx
    register_sql_functions(spark)
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev = ev.select("event_id", "ts", "props", F.date_format("ts", "yyyyMMddHHmmss").alias("rid"),
                   fx.epoch_ms(F.col("ts")).alias("ms"), F.lit("PAYMENT_SOURCE__X").alias("nm"))
    cols = ev.select(
        "event_id", scalars.epoch_ms_to_run_id("ms", "PST8PDT").alias("a"), scalars.run_id_to_epoch_ms("rid").alias("b"),
        scalars.run_sequence("ts", 7).alias("c"), scalars.elapsed_sequences(F.date_trunc("DAY", "ts").cast(
            "timestamp_ntz"), F.col("ts"), 15).alias("d"), scalars.json_attr("props", "k", "-1").alias("e"),
        scalars.short_name("nm", 2).alias("f"), scalars.checksum("props").alias("g"),
        scalars.truncate("props", 5).alias("h"), scalars.partition_key("ts", "MONTH").alias("i"))
    ev.createOrReplaceTempView("ev_sql_fn")
    sql = spark.sql("""SELECT event_id, epoch_ms_to_run_id(ms, 'PST8PDT') AS a, run_id_to_epoch_ms(rid, 'PST8PDT') AS b,
        run_sequence(ts, 7) AS c, elapsed_sequences(CAST(date_trunc('DAY', ts) AS TIMESTAMP_NTZ), ts, 15) AS d,
        json_attr(props, '$.k', '-1') AS e, short_name(nm, 2) AS f, text_checksum(props) AS g,
        truncate_text(props, 5) AS h, partition_key(ts, 'MONTH') AS i FROM ev_sql_fn""")
    assert rows(sql) == rows(cols)
    gap = spark.sql("SELECT run_id_to_epoch_ms('20240310023000', 'PST8PDT') AS x").first()["x"]
    assert int(gap) == int(D(2024, 3, 10, 9, 30, tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_filter_window_prunes_raw_partitions(spark):
    d = scratch_dir(spark, "t_prune")
    df = spark.createDataFrame([(i, D(2024, 1 + i % 12, 1 + i % 28, i % 24)) for i in range(300)],
                               "id int, t timestamp_ntz")
    sinks.append_raw(df, d, "t", "DAY")
    raw = spark.read.parquet(d)
    pruned = project.filter_window(raw, "t", "20240301000000", "20240331235959", partition_column="t_part")
    plain = project.filter_window(raw, "t", "20240301000000", "20240331235959")
    assert rows(pruned) == rows(plain) and pruned.count() > 0
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = pruned._jdf.queryExecution().explainString(mode)
    line = next(ln for ln in plan.splitlines() if ln.startswith("PartitionFilters"))
    assert "t_part" in line and "2024-03-01" in line and "2024-04-01" in line

import datetime as dt

import pytest
from pyspark.sql import functions as F

from result_rows import rows
from lakeload.operators import dedup, merge
from lakeload.plans.upsert import incremental_merge, run_upsert
from lakeload.session import scratch_dir
from lakeload.spec import LoadSpec, TableSpec

D = dt.datetime
SCHEMA = "k bigint, v string, o timestamp_ntz, n bigint"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_latest_forms_agree_and_keep_null_orders(spark):
    df = frame(spark, [
        (1, "a", D(2024, 1, 1), 1), (1, "b", D(2024, 1, 2), 2), (1, "c", None, 3),
        (2, "d", None, 4), (2, "e", None, 5),            # only NULL order values: still a row
        (None, "f", D(2024, 1, 1), 6), (None, "g", D(2024, 1, 3), 7),  # NULL keys: one group
    ])
    agg = dedup.latest_by_agg(df, ["k"], ["o", "n"])
    win = dedup.latest_by_window(df, ["k"], ["o", "n"], rank_col=None)
    assert rows(agg) == rows(win)
    got = {r["k"]: r["v"] for r in agg.collect()}
    assert got == {1: "b", 2: "e", None: "g"}  # DESC, NULLs last; tie broken by n


def test_latest_by_window_keeps_rank_column(spark):
    df = frame(spark, [(1, "a", D(2024, 1, 1), 1), (1, "b", D(2024, 1, 2), 2)])
    out = dedup.latest_by_window(df, ["k"], ["o"])
    assert out.columns[-1] == "RNK" and rows(out, "v", "RNK") == [("b", 1)]


def snapshot_spec(**kw):
    base = dict(primary_keys=("k",), ordering=("o", "n"), partition_field="o", partition_unit="YEAR",
                null_partition="allow")
    base.update(kw)
    return TableSpec(**base)


def test_merge_semantics(spark):
    target = frame(spark, [
        (1, "t1", D(2023, 5, 1), 1),     # updated (source newer)
        (2, "t2", D(2023, 6, 1), 9),     # guard false (source older): kept
        (3, "t3", None, 3),              # NULL guard column in target: never updated (T4)
        (None, "tn", D(2023, 1, 1), 4),  # NULL key: never matches (T1)
        (5, "t5", D(2020, 1, 1), 5),     # outside touched partitions: untouched
    ])
    source = frame(spark, [
        (1, "s1", D(2023, 7, 1), 10), (2, "s2", D(2023, 1, 1), 11), (3, "s3", D(2023, 2, 1), 12),
        (None, "sn", D(2023, 3, 1), 13), (6, "s6", D(2023, 3, 1), 14),
    ])
    out = merge.merge_upsert(target, source, snapshot_spec())
    assert rows(out, "k", "v") == sorted([(1, "s1"), (2, "t2"), (3, "t3"), (None, "tn"), (5, "t5"),
                                          (None, "sn"), (6, "s6")], key=repr)


def test_merge_explicit_guard_is_strict(spark):
    target = frame(spark, [(1, "t1", D(2023, 5, 1), 5), (2, "t2", D(2023, 5, 1), 5)])
    source = frame(spark, [(1, "s1", D(2023, 5, 1), 5), (2, "s2", D(2023, 5, 1), 6)])
    out = merge.merge_upsert(target, source, snapshot_spec(matched="n"))
    assert rows(out, "k", "v") == [(1, "t1"), (2, "s2")]
    # the default guard (<= on the first order column) updates on equal values
    out = merge.merge_upsert(target, source, snapshot_spec())
    assert rows(out, "k", "v") == [(1, "s1"), (2, "s2")]


def test_merge_update_lists(spark):
    target = frame(spark, [(1, "t1", D(2023, 5, 1), 7), (2, "t2", D(2023, 5, 1), 8)])
    source = frame(spark, [(1, None, D(2023, 6, 1), None), (3, "s3", D(2023, 6, 1), 9)])
    spec = snapshot_spec(keep_if_null=("v",), never_update=("n",))
    out = merge.merge_upsert(target, source, spec)
    assert rows(out, "k", "v", "n") == [(1, "t1", 7), (2, "t2", 8), (3, "s3", 9)]
    # columns outside the list keep their value on update and are NULL on insert
    out = merge.merge_upsert(target, source, snapshot_spec(), columns=["k", "o", "v"])
    assert rows(out, "k", "v", "n") == [(1, None, 7), (2, "t2", 8), (3, "s3", None)]


def test_partition_move_outside_scope_inserts_second_row(spark):
    # Key 1 lives in 2020 (not touched); the source row for key 1 is in 2023
    target = frame(spark, [(1, "old", D(2020, 1, 1), 1)])
    source = frame(spark, [(1, "new", D(2023, 1, 1), 2)])
    assert rows(merge.merge_upsert(target, source, snapshot_spec()), "k", "v") == [(1, "new"), (1, "old")]
    assert rows(merge.merge_upsert(target, source, snapshot_spec(), scope="all"), "k", "v") == [(1, "new")]


def test_partition_nulls_error_policy(spark):
    src = frame(spark, [(1, "a", None, 1)])
    spec = snapshot_spec(null_partition="error")
    with pytest.raises(Exception, match="NULL"):
        merge.check_partition_nulls(src, spec).collect()
    allowed = merge.touched_partitions_frame(src, snapshot_spec())
    assert rows(allowed) == [(D(1970, 1, 1),)]
    assert merge.touched_bounds(allowed, snapshot_spec()) == merge.Bounds(None, None, stand_in=True)      # no bound, only a match


@pytest.mark.parametrize("with_bounds", [False, True])
def test_split_scope_is_one_form_for_any_number_of_keys(spark, with_bounds):
    target = frame(spark, [(1, "t", D(2021, 1, 1), 1), (2, "t", D(2022, 1, 1), 1), (3, "t", D(2023, 1, 1), 1), (4, "t", None, 1)])
    source = frame(spark, [(1, "s", D(2021, 3, 1), 2), (3, "s", D(2023, 3, 1), 2)])
    for policy, more in (("error", []), ("allow", [(4,)])):
        spec = snapshot_spec(null_partition=policy)
        touched = merge.touched_partitions_frame(source, spec)
        inside, rest = merge.split_scope(target, spec, touched, merge.touched_bounds(touched, spec) if with_bounds else None)
        assert rows(inside, "k") == [(1,), (3,)] + more
        assert rows(inside.unionByName(rest), "k") == [(1,), (2,), (3,), (4,)]


def test_scope_filters_reach_the_scan_and_the_slice_is_read_once(spark):
    from lakeload.plans.upsert import dry_run_upsert
    from lakeload.session import written
    spec = snapshot_spec(null_partition="error", partition_unit="MONTH", partition_column="o_part")
    path, raw_path = scratch_dir(spark, "t_scope"), scratch_dir(spark, "t_scope_raw")
    frame(spark, [(k, f"v{k}", D(2023, 1 + k % 12, 1), k) for k in range(60)]).write.parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    run_upsert(spark, raw, path, spec, LoadSpec(audit_column="o"), "20221231000000", "20231231235959")
    touched = written(merge.touched_partitions_frame(raw, spec), "t_touched")
    plan = dry_run_upsert(raw, spark.read.parquet(path), spec, LoadSpec(audit_column="o"), "20221231000000",
                          "20231231235959", touched=touched).plan
    assert "PartitionFilters: [isnotnull(o_part" in plan and "(o_part" in plan
    scans = [ln for ln in plan.splitlines() if ln.startswith("Location") and "t_scope_raw" in ln]
    assert len(scans) == 1


def test_merge_is_idempotent(spark):
    raw = frame(spark, [(k % 5, f"v{k}", D(2023, 1 + k % 12, 1), k) for k in range(40)])
    spec = snapshot_spec(null_partition="error")
    load = LoadSpec(audit_column="o")
    empty = raw.limit(0)
    once = incremental_merge(raw, empty, spec, load, "20221231000000", "20240101000000")
    twice = incremental_merge(raw, once, spec, load, "20221231000000", "20240101000000")
    assert rows(once) == rows(twice)
    assert once.count() == 5  # raw distinct keys == snapshot rows after a full merge


def test_run_upsert_rewrites_only_touched_partitions(spark):
    spec = snapshot_spec(null_partition="error", partition_unit="MONTH", partition_column="o_part")
    load = LoadSpec(audit_column="o")
    raw = frame(spark, [(k, f"v{k}", D(2023, 1 + k % 6, 1 + k % 20), k) for k in range(60)]
                + [(k, f"w{k}", D(2023, 7, 1 + k % 20), 100 + k) for k in range(0, 60, 7)])
    path = scratch_dir(spark, "test_upsert")
    run_upsert(spark, raw, path, spec, load, "20221231000000", "20230630235959")
    first = spark.read.parquet(path).drop("o_part")
    # the window's end (June 30 23:59:59 in PST8PDT) is July 1 06:59:59 UTC: the
    # July 1 00:00 rows belong to the first run, so July is touched twice
    first = spark.createDataFrame(first.collect(), first.schema)  # a frame listed before a swap goes stale
    assert first.count() == 60
    res = run_upsert(spark, raw, path, spec, load, "20230701000000", "20230731235959")
    assert res.partitions == ["o_part=2023-07-01"]
    out = spark.read.parquet(path)
    lazy = incremental_merge(raw, first, spec, load, "20230701000000", "20230731235959")
    assert rows(out.drop("o_part")) == rows(lazy)
    assert rows(out.where(F.col("k") == 7), "v") == [("v7",), ("w7",)]  # new month: inserted (T2)


def test_bucketed_upsert_matches_path_upsert_and_skips_target_shuffle(spark):
    from lakeload.plans.upsert import run_upsert_bucketed
    spec = snapshot_spec(null_partition="error", partition_unit="MONTH", partition_column="o_part", buckets=4)
    load = LoadSpec(audit_column="o")
    raw = frame(spark, [(k % 23, f"v{k}", D(2023, 1 + k % 9, 1 + k % 20), k) for k in range(200)])
    windows = [("20221231000000", "20230430235959"), ("20230501000000", "20231231235959")]
    path = scratch_dir(spark, "t_plain")
    name = "t_bucketed_snapshot"
    for lo, hi in windows:
        run_upsert(spark, raw, path, spec, load, lo, hi)
        run_upsert_bucketed(spark, raw, name, spec, load, lo, hi, path=scratch_dir(spark, "t_bucketed"))
    assert rows(spark.table(name).drop("o_part")) == rows(spark.read.parquet(path).drop("o_part"))
    # a merge-style join on the key reads the snapshot bucketed: its side has no exchange
    src = raw.groupBy("k").agg(F.max("o").alias("m")).repartition(4, "k")
    joined = spark.table(name).where("k IS NOT NULL").join(src, "k", "full_outer")
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    plan = joined._jdf.queryExecution().explainString(mode)
    scan = [ln for ln in plan.splitlines() if "t_bucketed_snapshot" in ln]
    assert scan and "Bucketed: true" in scan[0]
    src_plan = src._jdf.queryExecution().explainString(mode)
    assert plan.count("Exchange") == src_plan.count("Exchange")  # every exchange is on the source side


def test_key_casts_that_collide_raise(spark):
    target = spark.createDataFrame([(1, "t")], "k bigint, v string")
    source = spark.createDataFrame([("1", "a"), ("01", "b")], "k string, v string")  # both cast to 1
    spec = TableSpec(primary_keys=("k",), casts={"k": "INT64"})
    with pytest.raises(Exception, match="more than one source row"):
        merge.merge_upsert(target, source, spec).collect()
    ok = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    assert rows(merge.merge_upsert(target, ok, spec), "k", "v") == [(1, "a"), (2, "b")]


def test_dry_run_plans_without_running(spark):
    from lakeload.plans.upsert import dry_run_upsert
    raw = frame(spark, [(1, "a", D(2023, 5, 1), 1)])
    jobs_before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    res = dry_run_upsert(raw, raw, snapshot_spec(null_partition="error"), LoadSpec(audit_column="o"),
                         "20230101000000", "20231231235959")
    assert "SortMergeJoin" in res.plan or "HashJoin" in res.plan
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == jobs_before


def test_run_upsert_hourly_partitions(spark):
    spec = snapshot_spec(null_partition="error", partition_unit="HOUR", partition_column="o_hour")
    raw = frame(spark, [(k, f"v{k}", D(2023, 1, 1, k % 5), k) for k in range(20)])
    path = scratch_dir(spark, "t_hourly")
    run_upsert(spark, raw, path, spec, LoadSpec(audit_column="o"), "20221231000000", "20230102000000")
    out = spark.read.parquet(path)
    assert out.count() == 20 and dict(out.dtypes)["o_hour"] == "int"
    assert sorted(r[0] for r in out.select("o_hour").distinct().collect()) == [2023010100 + h for h in range(5)]


def test_run_upsert_without_the_partition_field_keeps_its_inserts(spark):
    load = LoadSpec(audit_column="o")
    for policy in ("error", "allow"):
        spec = snapshot_spec(null_partition=policy, partition_unit="MONTH", partition_column="o_part")
        raw = frame(spark, [(k, f"v{k}", D(2023, 1 + k % 3, 1), k) for k in range(9)])
        path = scratch_dir(spark, "t_columns")
        run_upsert(spark, raw, path, spec, load, "20221231000000", "20231231235959")
        more = frame(spark, [(1, "w1", D(2023, 2, 5), 50), (100, "w100", D(2023, 2, 5), 51), (101, "w101", D(2023, 2, 5), 52)])
        before = spark.createDataFrame(spark.read.parquet(path).drop("o_part").collect(), raw.schema)
        res = run_upsert(spark, more, path, spec, load, "20221231000000", "20231231235959", columns=["k", "v", "n"])
        lazy = incremental_merge(more, before, spec, load, "20221231000000", "20231231235959", columns=["k", "v", "n"])
        out = spark.read.parquet(path)
        assert rows(out.drop("o_part"), *before.columns) == rows(lazy)
        assert out.where("k >= 100 AND o_part IS NULL").count() == 2
        assert "o_part=__HIVE_DEFAULT_PARTITION__" in res.partitions
        # a later run adds to the NULL partition instead of replacing it
        more = frame(spark, [(200, "x", D(2023, 2, 6), 60)])
        run_upsert(spark, more, path, spec, load, "20221231000000", "20231231235959", columns=["k", "v", "n"])
        assert rows(spark.read.parquet(path).where("o_part IS NULL"), "k") == [(100,), (101,), (200,)]


def test_run_upsert_with_a_cast_that_moves_the_partition(spark):
    load = LoadSpec(audit_column="o")
    spec = snapshot_spec(null_partition="error", partition_unit="HOUR", partition_column="o_part")
    path = scratch_dir(spark, "t_moving")
    first = frame(spark, [(1, "a", D(2023, 1, 1, 0), 1), (2, "b", D(2023, 1, 1, 7), 2)])
    run_upsert(spark, first, path, spec, load, "20221230000000", "20231231235959")
    moving = TableSpec(**{**spec.__dict__, "casts": {"o": "DATE"}})       # 09:00 becomes 00:00
    run_upsert(spark, frame(spark, [(3, "c", D(2023, 1, 1, 9), 3)]), path, moving, load, "20221230000000", "20231231235959")
    out = spark.read.parquet(path)
    assert rows(out, "k", "o_part") == [(1, 2023010100), (2, 2023010107), (3, 2023010100)]

"""Every registered query against its DuckDB oracle on the smallest test tables."""

import pytest

import __spark_entry__ as entry_mod
from oracle_check import digest, duck, type_diffs

SF = "/root/testdata/sf0.001"
QUERIES = entry_mod.queries()
ORACLE = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0 and "o_custkey" in df.columns


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert df.columns
        return
    res = con.execute(ORACLE[name])
    want_cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(want_cols)
    assert not type_diffs(df, res)
    assert len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(want_cols, want)[0]


@pytest.mark.parametrize("name", ["m1_merge_upsert", "m3_guard_default", "m6_scope_partitions",
                                  "m7_touched_partitions_nulls", "j3_without_committed_run", "n4_all_stats",
                                  "w6_catch_up", "f1_epoch_ms_to_run_id", "s2_scan_ndjson", "k1_append_raw",
                                  "f9_partition_key", "f9_partition_key_instant", "p6_filter_window_instant"])
@pytest.mark.parametrize("zone", ["America/New_York", "America/Los_Angeles"])
def test_results_do_not_depend_on_session_zone(spark, con, name, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = QUERIES[name](spark, SF)
        got = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = con.execute(ORACLE[name])
    want_cols = [d[0] for d in res.description]
    assert digest(df.columns, got)[0] == digest(want_cols, res.fetchall())[0]

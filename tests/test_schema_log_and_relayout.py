"""The schema log under concurrent and failing appends; history moved once."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from result_rows import rows
from lakeload.session import scratch_dir
from lakeload.sinks import tables


def test_two_appends_at_once_keep_both_columns(spark, monkeypatch):
    path = scratch_dir(spark, "t_log")
    tables.append_raw(spark.range(3).select("id"), path)
    both, real = threading.Barrier(2), tables._claim_version
    tries = []

    def claim(spark_, path_, number, schema):
        tries.append(number)
        if len(tries) <= 2:
            both.wait(60)            # both have read the same version by now
        return real(spark_, path_, number, schema)
    monkeypatch.setattr(tables, "_claim_version", claim)
    batches = [spark.range(10 * i, 10 * i + 2).select("id", F.lit(i).alias(f"c{i}")) for i in (1, 2)]
    work = [threading.Thread(target=tables.append_with_new_fields, args=(b, path)) for b in batches]
    for t in work:
        t.start()
    for t in work:
        t.join()
    assert sorted(tries) == [1, 1, 2]
    out = tables.read_evolved(spark, path)
    assert sorted(out.columns) == ["c1", "c2", "id"] and out.count() == 7
    assert rows(out.where("c1 IS NOT NULL"), "id", "c1", "c2") == [(10, 1, None), (11, 1, None)]
    assert rows(out.where("c2 IS NOT NULL"), "id", "c1", "c2") == [(20, None, 2), (21, None, 2)]


def test_an_append_that_ends_while_another_one_writes_takes_nothing_from_it(spark, tmp_path):
    path, flag = scratch_dir(spark, "t_log"), tmp_path / "first load is done"
    tables.append_with_new_fields(spark.range(3).select("id", F.lit("a").alias("p")), path)

    @F.udf("bigint")
    def later(i):
        import time
        end = time.monotonic() + 60
        while i >= 400 and not flag.exists() and time.monotonic() < end:
            time.sleep(0.05)
        return i + 0
    slow = spark.range(100, 500, 1, 1).select(later("id").alias("id"), F.lit("b").alias("p"), F.lit(1).alias("c1"))
    failed = []

    def load():
        try:
            tables.append_with_new_fields(slow, path)
        except Exception as e:      # noqa: BLE001
            failed.append(e)
    work = threading.Thread(target=load)
    work.start()
    deadline, there = time.monotonic() + 60, path.removeprefix("file://")
    while time.monotonic() < deadline and not any("_temporary" in d and any(f.endswith(".parquet") for f in fs) for d, _, fs in os.walk(there)):
        time.sleep(0.02)             # the slow load's first file is on its way
    tables.append_with_new_fields(spark.range(1000, 1004).select("id", F.lit("c").alias("p"), F.lit(2).alias("c2")), path)
    flag.touch()
    work.join()
    assert not failed
    ids = [i for i, in rows(tables.read_evolved(spark, path), "id")]
    assert sorted(ids) == [0, 1, 2, *range(100, 500), *range(1000, 1004)]
    assert not [n for n in os.listdir(there) if n.startswith((tables.LOAD, "_temporary"))]


def test_an_append_whose_files_cannot_join_leaves_the_table_as_it_was(spark, monkeypatch):
    path = scratch_dir(spark, "t_log")
    load = lambda a, b: spark.range(a, b, 1, 3).select("id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 2 AS int))").alias("t"))
    tables.append_raw(load(0, 6), path, "t", "DAY")
    real, made = tables.Store.rename, []

    def breaks(self, a, b):
        if tables.LOAD in a:
            made.append(b)
            if len(made) == 2:
                raise OSError("the store refuses")
        real(self, a, b)
    monkeypatch.setattr(tables.Store, "rename", breaks)
    with pytest.raises(OSError, match="refuses"):
        tables.append_raw(load(6, 12), path, "t", "DAY")
    monkeypatch.undo()
    read = lambda: sorted(i for i, in rows(spark.read.parquet(path), "id"))
    assert len(made) == 2 and read() == list(range(6))
    tables.append_raw(load(6, 12), path, "t", "DAY")
    assert read() == list(range(12))
    assert not [n for n in os.listdir(path.removeprefix("file://")) if n.startswith(tables.LOAD)]


def test_a_load_that_ends_before_its_rows_loses_no_column(spark, monkeypatch):
    path = scratch_dir(spark, "t_log")
    tables.append_with_new_fields(spark.range(2).select("id"), path)
    real = tables.append_raw

    def ends(*args, **kw):
        raise RuntimeError("the driver ends here")
    monkeypatch.setattr(tables, "append_raw", ends)
    batch = spark.range(5, 6).select("id", F.struct(F.lit("x").alias("a")).alias("s"))
    with pytest.raises(RuntimeError):
        tables.append_with_new_fields(batch, path)
    monkeypatch.setattr(tables, "append_raw", real)
    assert rows(tables.read_evolved(spark, path), "id") == [(0,), (1,)]
    assert tables.read_evolved(spark, path).columns == ["id", "s"]
    tables.append_with_new_fields(batch, path)
    tables.append_with_new_struct_fields(spark.range(7, 8).select("id", F.struct(F.lit(1).alias("b")).alias("s")), path)
    assert rows(tables.read_evolved(spark, path).select("id", "s.*")) == [(0, None, None), (1, None, None), (5, "x", None), (7, None, 1)]


def test_a_changed_type_leaves_the_log_as_it_is(spark):
    path = scratch_dir(spark, "t_log")
    tables.append_with_new_fields(spark.range(2).select("id"), path)
    tables.append_with_new_fields(spark.range(2).select("id"), path)      # nothing new: no new version
    log = lambda: sorted(n for n in os.listdir(f"{path}/_schema") if n[0].isdigit())
    assert log() == ["00000001.json"]
    with pytest.raises(ValueError, match="id is bigint"):
        tables.append_with_new_fields(spark.range(2).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("c")), path)
    assert log() == ["00000001.json"] and tables.read_evolved(spark, path).count() == 4


def history(spark, root, month, n, part="p"):
    spark.range(n).select(F.col("id"), F.lit(month).alias("m")).coalesce(1).write.mode("overwrite").parquet(f"{root}/h/data/h_{month}/{part}")


def stamps(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_history_is_moved_once(spark):
    src, dst = scratch_dir(spark, "t_hist"), scratch_dir(spark, "t_hist_out")
    for month, n in (("20230101", 3), ("20230201", 4)):
        history(spark, src, month, n)
    assert tables.relayout_history(spark, src, dst, "h").count() == 7
    first = stamps(dst)
    assert rows(tables.relayout_history(spark, src, dst, "h").groupBy("snapshot_date").count(), "count") == [(3,), (4,)]
    assert stamps(dst) == first                                                    # a second run writes nothing
    history(spark, src, "20230301", 5)
    assert tables.relayout_history(spark, src, dst, "h").count() == 12
    second = stamps(dst)
    assert first.items() <= second.items()                                         # one added folder: one partition
    assert {f.split("snapshot_date=")[1][:10] for f in second.keys() - first.keys()} == {"2023-03-01"}
    history(spark, src, "20230201", 2)                                             # a folder that changed
    history(spark, src, "20230101", 1, part="q")                                   # a file that came later
    assert rows(tables.relayout_history(spark, src, dst, "h").groupBy("m").count()) == [("20230101", 4), ("20230201", 2), ("20230301", 5)]


def test_a_folder_that_went_takes_its_partition_along(spark):
    import shutil
    src, dst = scratch_dir(spark, "t_hist"), scratch_dir(spark, "t_hist_out")
    for month in ("20230101", "20230201"):
        history(spark, src, month, 2)
    spark.range(1).select("id", F.lit("none").alias("m")).write.parquet(f"{src}/elsewhere")
    assert tables.relayout_history(spark, src, dst, "h").where("snapshot_date IS NULL").count() == 1
    shutil.rmtree(f"{src.removeprefix('file://')}/h/data/h_20230101")
    assert rows(tables.relayout_history(spark, src, dst, "h"), "m") == [("20230201",), ("20230201",), ("none",)]
    assert tables.relayout_history(spark, src, dst, "h").count() == 3

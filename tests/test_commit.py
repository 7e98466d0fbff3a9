"""Commits that are killed after any single step, and what the next run makes of them."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from result_rows import rows
from lakeload.operators import merge
from lakeload.plans.upsert import dry_run_upsert, files_with_keys, incremental_merge, run_upsert, run_upsert_bucketed
from lakeload.session import scratch_dir, written
from lakeload.sinks import commit as commits
from lakeload.sinks import tables
from lakeload.spec import LoadSpec, TableSpec

D = dt.datetime
LOAD = LoadSpec(audit_column="o")
WINDOW = ("20221231000000", "20231231235959")


class Killed(BaseException):
    """The driver's end: no handler of the library runs."""


@pytest.fixture
def kill_after(monkeypatch):
    """kill_after(n): the n-th step of a commit is the last one (None: none is)."""
    left = [None]

    def stepping(name):
        real = getattr(commits.Store, name)

        def step(self, *args):
            real(self, *args)
            if left[0] is not None:
                left[0] -= 1
                if left[0] == 0:
                    left[0] = None
                    raise Killed(name)
        return step
    for name in ("rename", "write", "delete", "sql"):
        monkeypatch.setattr(commits.Store, name, stepping(name))
    return lambda n: left.__setitem__(0, n)


def spec_of(**more):
    return TableSpec(**{**dict(primary_keys=("k",), ordering=("o", "n"), partition_field="o", partition_unit="MONTH",
                               partition_column="o_part"), **more})


def frame(spark, data):
    return spark.createDataFrame(data, "k bigint, v string, o timestamp_ntz, n bigint")


def first_rows(spark):
    return frame(spark, [(k, f"v{k}", D(2023, 1 + k % 3, 1 + k), k) for k in range(9)])


def later_rows(spark):
    """An update, a new partition, and (with the column list) rows that land outside the scope."""
    return frame(spark, [(1, "w1", D(2023, 2, 20), 50), (3, "w3", D(2023, 1, 20), 51), (100, "w100", D(2023, 5, 5), 52)])


def fresh(spark, path):
    return spark.read.parquet(path)


def killed_at_each_step(spark, kill_after, prepare, run, read, repair):
    """Old data while no intent is in place, the new from then on; the next writer begins with it."""
    place = prepare()
    old = rows(read(place))
    run(place)
    new = rows(read(place))
    assert old != new
    outcomes = []
    for n in range(1, 200):
        place = prepare()
        kill_after(n)
        try:
            run(place)
        except Killed:
            pass
        else:
            kill_after(None)
            assert rows(read(place)) == new
            break
        repair(place)
        got = rows(read(place))
        assert got in (old, new), n
        outcomes.append(got == new)
        assert repair(place) == 0 and rows(read(place)) == got           # nothing left to do
        run(place)
        assert rows(read(place)) == new, n                                # and the load can be run again
    assert outcomes == sorted(outcomes) and outcomes.count(False) <= 1 and outcomes.count(True) >= 3


@pytest.mark.parametrize("rewrite,columns", [("partitions", None), ("files", None), ("partitions", ["k", "v", "n"])])
def test_an_upsert_killed_after_any_step_ends_whole(spark, kill_after, rewrite, columns):
    spec, first, later = spec_of(rewrite=rewrite), first_rows(spark), later_rows(spark)

    def prepare():
        path = scratch_dir(spark, "t_killed")
        run_upsert(spark, first, path, spec, LOAD, *WINDOW)
        if columns:       # rows without the partition field join those of the NULL partition
            run_upsert(spark, frame(spark, [(500, "x", D(2023, 2, 1), 1)]), path, spec, LOAD, *WINDOW, columns=columns)
        return path
    if columns:           # such a run inserts again, so only its first outcome is compared
        later = frame(spark, [(1, "w1", D(2023, 2, 20), 50), (600, "y", D(2023, 2, 21), 51)])
        path = prepare()
        old = rows(fresh(spark, path))
        run_upsert(spark, later, path, spec, LOAD, *WINDOW, columns=columns)
        new = rows(fresh(spark, path))
        for n in range(1, 9):
            path = prepare()
            kill_after(n)
            with pytest.raises(Killed):
                run_upsert(spark, later, path, spec, LOAD, *WINDOW, columns=columns)
            commits.recover(spark, path)
            assert rows(fresh(spark, path)) == (old if n == 1 else new), n
        return
    killed_at_each_step(spark, kill_after, prepare, lambda path: run_upsert(spark, later, path, spec, LOAD, *WINDOW),
                        lambda path: fresh(spark, path), lambda path: commits.recover(spark, path))


def test_a_first_load_and_a_full_load_killed_after_any_step_end_whole(spark, kill_after):
    def prepare():
        path = scratch_dir(spark, "t_full")
        tables.full_load(spark, first_rows(spark), path)
        return path
    killed_at_each_step(spark, kill_after, prepare, lambda path: tables.full_load(spark, later_rows(spark), path),
                        lambda path: fresh(spark, path), lambda path: commits.recover(spark, path))
    for n in range(1, 4):
        path = scratch_dir(spark, "t_first")
        kill_after(n)
        with pytest.raises(Killed):
            run_upsert(spark, first_rows(spark), path, spec_of(), LOAD, *WINDOW)
        kill_after(None)
        run_upsert(spark, first_rows(spark), path, spec_of(), LOAD, *WINDOW)
        assert fresh(spark, path).count() == 9


def test_a_catalog_upsert_points_partitions_and_ends_whole(spark, kill_after):
    spec, names = spec_of(buckets=2), iter(range(1000))
    made = {}

    def prepare():
        name = f"t_pointed_{next(names)}_{os.getpid()}"
        made[name] = scratch_dir(spark, name)
        run_upsert_bucketed(spark, first_rows(spark), name, spec, LOAD, *WINDOW, path=made[name])
        return name

    def run(name):
        run_upsert_bucketed(spark, later_rows(spark), name, spec, LOAD, *WINDOW)

    def read(name):
        spark.catalog.refreshTable(name)
        return spark.table(name)
    killed_at_each_step(spark, kill_after, prepare, run, read, lambda name: commits.recover(spark, made[name]))
    name = prepare()
    run(name)
    location = next(r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION (o_part='2023-01-01')").collect() if r[0] == "Location")
    assert "_versions/" in location


def test_a_failing_step_takes_the_commit_back(spark, monkeypatch):
    path = scratch_dir(spark, "t_undone")
    run_upsert(spark, first_rows(spark), path, spec_of(), LOAD, *WINDOW)
    before, real, calls = rows(fresh(spark, path)), commits.Store.rename, []

    def failing(self, a, b):
        calls.append(a)
        if len(calls) == 5:
            raise OSError("refused")
        real(self, a, b)
    monkeypatch.setattr(commits.Store, "rename", failing)
    with pytest.raises(OSError, match="refused"):
        run_upsert(spark, later_rows(spark), path, spec_of(), LOAD, *WINDOW)
    monkeypatch.setattr(commits.Store, "rename", real)
    assert rows(fresh(spark, path)) == before and commits.recover(spark, path) == 0


def test_nothing_is_begun_when_staged_data_is_missing(spark, tmp_path):
    for d in ("t/a", "t/b", "s/a"):
        (tmp_path / d).mkdir(parents=True)
        (tmp_path / d / "x").write_text(d)
    moves = [(f"{tmp_path}/s/a", f"{tmp_path}/t/a"), (f"{tmp_path}/s/missing", f"{tmp_path}/t/b")]
    with pytest.raises(OSError, match="missing"):
        commits.commit(spark, f"{tmp_path}/t", moves)
    assert (tmp_path / "t/a/x").read_text() == "t/a" and (tmp_path / "s/a/x").read_text() == "s/a"
    assert commits.commit(spark, f"{tmp_path}/t", [moves[0]], [f"{tmp_path}/t/b"]) == 1
    assert (tmp_path / "t/a/x").read_text() == "s/a" and not (tmp_path / "t/b").exists()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["s", "t"]


def test_recovery_stops_at_a_folder_that_someone_else_wrote(spark, tmp_path, kill_after):
    for d in ("t/a", "s/a"):
        (tmp_path / d).mkdir(parents=True)
        (tmp_path / d / "x").write_text(d)
    kill_after(3)              # the intent is written and put in place, the old folder is aside
    with pytest.raises(Killed):
        commits.commit(spark, f"{tmp_path}/t", [(f"{tmp_path}/s/a", f"{tmp_path}/t/a")])
    (tmp_path / "t/a").mkdir()
    with pytest.raises(OSError, match="someone else"):
        commits.recover(spark, f"{tmp_path}/t")


# ---------------------------------------------------------------- scope with NULL partitions

def test_an_allowed_null_partition_reads_its_folder_and_the_touched_day_only(spark):
    spec = spec_of(null_partition="allow", partition_unit="DAY")
    raw = frame(spark, [(k, f"v{k}", D(2023, 1 + k % 12, 1 + k % 28), k) for k in range(200)] + [(900, "n", None, 1)])
    path = scratch_dir(spark, "t_null_scope")
    run_upsert(spark, raw, path, spec, LOAD, *WINDOW, whole_table=True)
    assert len([d for d in os.listdir(path) if d.startswith("o_part=")]) > 50
    slice_ = frame(spark, [(3, "w3", D(2023, 4, 4), 900), (900, "m", None, 901)])
    touched = written(merge.touched_partitions_frame(slice_, spec), "t_touched")
    bounds = merge.touched_bounds(touched, spec)
    assert bounds == merge.Bounds(D(2023, 4, 4), D(2023, 4, 4), True)
    inside, _ = merge.split_scope(spark.read.parquet(path), spec, touched, bounds)
    folders = {r[0].rsplit("/", 2)[1] for r in inside.select(F.col("o_part")).join(
        spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"), F.col("o_part").alias("p")),
        F.expr("o_part <=> p")).select("f").distinct().collect()}
    assert folders == {"o_part=2023-04-04", "o_part=__HIVE_DEFAULT_PARTITION__"}
    plan = dry_run_upsert(slice_, spark.read.parquet(path), spec, LOAD, *WINDOW, whole_table=True, touched=touched).plan
    filters = [ln for ln in plan.splitlines() if ln.startswith("PartitionFilters")]
    # every scan of the target is of the touched day (and the day that stands for NULL) or of the NULL folder alone
    assert filters and all(f.count("2023-04-04") == 2 or f.startswith("PartitionFilters: [isnull(o_part#") for f in filters)
    assert any("isnull(" in f for f in filters) and any("2023-04-04" in f for f in filters)
    before = spark.createDataFrame(fresh(spark, path).drop("o_part").collect(), raw.schema)
    run_upsert(spark, slice_, path, spec, LOAD, *WINDOW, whole_table=True)
    lazy = incremental_merge(slice_, before, spec, LOAD, *WINDOW, whole_table=True)
    assert rows(fresh(spark, path).drop("o_part")) == rows(lazy)


def test_rows_of_1970_and_of_null_match_like_one_partition(spark):
    spec = spec_of(null_partition="allow")
    target = frame(spark, [(1, "a", None, 1), (2, "b", D(1970, 1, 1), 1), (3, "c", D(2023, 5, 5), 1)])
    for data, inside_keys in (([(2, "x", None, 5)], [1, 2]), ([(3, "x", D(2023, 5, 6), 5)], [1, 3]), ([], [1])):
        touched = merge.touched_partitions_frame(frame(spark, data), spec)
        for bounds in (None, merge.touched_bounds(touched, spec)):
            inside, rest = merge.split_scope(target, spec, touched, bounds)
            assert [r[0] for r in rows(inside, "k")] == inside_keys
            assert [r[0] for r in rows(rest, "k")] == sorted({1, 2, 3} - set(inside_keys))


# ---------------------------------------------------------------- merge by files

def many_files(spark, path, spec, n=50, per=40):
    data = frame(spark, [(k, f"v{k}", D(2023, 3, 1 + k % 20), k) for k in range(n * per)])
    out = data.repartitionByRange(n, "k")
    if spec.partition_field:
        out.withColumn("o_part", F.lit("2023-03-01").cast("date")).write.partitionBy("o_part").parquet(path)
    else:
        out.write.parquet(path)
    return data


@pytest.mark.parametrize("partitioned", [True, False])
def test_ten_keys_rewrite_the_files_that_hold_them_and_no_others(spark, partitioned):
    spec = spec_of(rewrite="files") if partitioned else spec_of(partition_field=None, partition_column=None)
    path = scratch_dir(spark, "t_files")
    data = many_files(spark, path, spec)
    listing = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_ino for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = listing()
    assert len(before) == 50
    later = frame(spark, [(k, f"w{k}", D(2023, 3, 25), 10 ** 6) for k in range(100, 140, 4)] + [(10 ** 7, "new", D(2023, 3, 2), 1), (None, "null key", D(2023, 3, 2), 1)])
    expected = incremental_merge(later, data, spec, LOAD, *WINDOW)
    want = rows(expected)
    held = files_with_keys(spark.read.parquet(path), later.select("k"), TableSpec(primary_keys=("k",)))
    res = run_upsert(spark, later, path, spec, LOAD, *WINDOW)
    after = listing()
    assert sorted(res.files) == [f.removeprefix("file://") if f.startswith("file:///") else f for f in held] or len(res.files) == len(held)
    assert 1 <= len(held) <= 2 and len(before.keys() - after.keys()) == len(held)
    assert all(after[f] == before[f] for f in before.keys() & after.keys())       # the others were not touched
    assert rows(fresh(spark, path).select("k", "v", "o", "n")) == want


def test_a_merge_by_files_without_any_match_only_adds(spark):
    spec = spec_of(partition_field=None, partition_column=None, casts={"k": "INT64"})
    path = scratch_dir(spark, "t_no_match")
    run_upsert(spark, first_rows(spark), path, spec, LOAD, *WINDOW)
    res = run_upsert(spark, frame(spark, [(77, "x", D(2023, 3, 3), 1)]), path, spec, LOAD, *WINDOW)
    assert res.files == [] and fresh(spark, path).count() == 10
    run_upsert(spark, frame(spark, []), path, spec, LOAD, *WINDOW)
    assert fresh(spark, path).count() == 10


def test_folder_names_with_odd_characters_survive_a_merge_by_files(spark):
    spec = TableSpec(primary_keys=("k",), ordering=("o",), partition_field="o", partition_unit="HOUR", partition_column="o_part", rewrite="files")
    path = scratch_dir(spark, "t odd %41 name")
    run_upsert(spark, first_rows(spark), path, spec, LOAD, *WINDOW)
    run_upsert(spark, frame(spark, [(4, "again", D(2023, 2, 5), 99)]), path, spec, LOAD, *WINDOW)
    assert fresh(spark, path).count() == 9 and rows(fresh(spark, path).where("k = 4"), "v") == [("again",)]


# ---------------------------------------------------------------- counts taken by the job that writes

def test_the_notes_of_loads_equal_a_recount(spark):
    from lakeload.operators.audit import audit_of_loads
    spec, path = spec_of(), scratch_dir(spark, "t_notes")
    res = [run_upsert(spark, data, path, spec, LOAD, *WINDOW) for data in (first_rows(spark), later_rows(spark))]
    res.append(run_upsert(spark, frame(spark, [(None, "n", D(2023, 2, 2), 1), (1, "again", D(2023, 2, 28), 99)]), path, spec_of(rewrite="files"), LOAD, *WINDOW))
    assert [r.inserted for r in res] == [9, 1, 1]          # one new key, then a NULL key
    got = audit_of_loads(spark, path).first()
    out = fresh(spark, path)
    assert (got.total_count, got.primary_key_null_count) == (out.count(), out.where("k IS NULL").count()) == (11, 1)
    raw = scratch_dir(spark, "t_notes_raw")
    for _ in range(2):
        tables.append_raw(first_rows(spark).withColumn("created_local_time", F.when(F.col("k") < 4, F.lit("2022-01-01 00:00:00")).cast("timestamp_ntz")),
                          raw, "o", "MONTH", audit_keys=["k", "n"])
    assert tuple(audit_of_loads(spark, raw).first()) == (18, 0, 8)

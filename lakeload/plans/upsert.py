"""Raw slice -> snapshot upsert, end to end.

    filter_window (pushed to the scan) -> filter_extra -> check_partition_nulls (lazy)
    -> touched partitions (a small scratch table) -> latest per key -> merge_rows on the
    in-scope target rows -> write only the touched partitions (stage, then swap)

Rows of untouched partitions are neither read nor rewritten. The write stages the
new partitions under a fresh folder next to the table and then commits them by whole
partition directories (``sinks/commit.py``), so a plan never overwrites a path it is
reading and a run after a lost driver finishes what that one had begun. Every staged
folder reaches the table: those in scope replace the old ones, and rows that land
outside the scope (no partition value in the column list, a cast that moves it) are
added to what their partition holds.

With ``spec.rewrite == "files"`` only the files that hold a key of the slice are read
whole and rewritten; the rest of a touched partition stays as it is. A table without a
partition field is always merged that way.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import partition_value
from ..operators.audit import load_metrics, loads_path
from ..operators.dedup import latest
from ..operators.merge import (Bounds, bounds_of, check_partition_nulls, merge_rows, read_bounds, scope_value,
                               source_keys, split_scope, touched_bounds, touched_partitions_frame)
from ..operators.project import filter_extra, filter_window, q
from ..session import hadoop_fs, written
from ..sinks.commit import commit, folders, recover
from ..sinks.tables import note_load
from ..spec import LoadSpec, TableSpec

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"   # fixed value: the folder name of a NULL partition


def source_slice(raw: DataFrame, spec: TableSpec, load: LoadSpec, start_run_id: str | None,
                 end_run_id: str | None, whole_table: bool = False) -> DataFrame:
    """The raw rows of one run window (or the whole table), extra predicate ANDed."""
    df = filter_extra(raw, spec.inner_where)
    if not whole_table:
        df = filter_window(df, load.audit_column, start_run_id, end_run_id, load.zone,
                           load.raw_partition_column, load.raw_partition_unit)
    return check_partition_nulls(df, spec)


def incremental_merge(raw: DataFrame, target: DataFrame, spec: TableSpec, load: LoadSpec,
                      start_run_id: str | None, end_run_id: str | None,
                      columns: Sequence[str] | None = None, whole_table: bool = False) -> DataFrame:
    """The new snapshot as a lazy frame (all rows)."""
    sl = source_slice(raw, spec, load, start_run_id, end_run_id, whole_table)
    src = latest(sl, spec.primary_keys, spec.ordering, spec.dedup)
    if not spec.partition_field:
        return merge_rows(target, src, spec, columns)
    touched = written(touched_partitions_frame(sl, spec), "touched")
    inside, rest = split_scope(target, spec, touched, touched_bounds(touched, spec))
    return merge_rows(inside, src, spec, columns).unionByName(rest)


@dataclass
class UpsertResult:
    """``partitions``: the partition folders that got new content (empty for a table without any); ``files``: those that
    a run by files has rewritten; ``inserted``: rows that the snapshot did not have."""
    partitions: list[str] = field(default_factory=list)
    rewritten_partitions: int = 0
    path: str = ""
    files: list[str] = field(default_factory=list)
    inserted: int | None = None
    plan: str | None = None


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def dry_run_upsert(raw: DataFrame, target: DataFrame, spec: TableSpec, load: LoadSpec,
                   start_run_id: str | None, end_run_id: str | None,
                   columns: Sequence[str] | None = None, whole_table: bool = False,
                   touched: DataFrame | None = None) -> UpsertResult:
    """The upsert's physical plan without running anything (no action, no write), as the
    reference's dry run only prints its statements. Given the ``touched`` frame of a run,
    the plan is the one a run executes (range filter on the partition column)."""
    sl = source_slice(raw, spec, load, start_run_id, end_run_id, whole_table)
    src = latest(sl, spec.primary_keys, spec.ordering, spec.dedup)
    if spec.buckets:  # as run_upsert_bucketed: the slice joins the snapshot's buckets
        src = src.repartition(spec.buckets, *[F.col(k) for k in spec.primary_keys])
    if spec.partition_field:
        inside, _ = split_scope(target, spec, touched_partitions_frame(sl, spec) if touched is None else touched,
                                None if touched is None else touched_bounds(touched, spec))
    else:
        inside = target
    merged = merge_rows(inside.select(*[c for c in target.columns if c != spec.partition_column]), src, spec,
                        columns)
    return UpsertResult(plan=explain_text(merged))


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return fs.exists(p)


def _touched(sl: DataFrame, spec: TableSpec) -> tuple[DataFrame, Bounds]:
    """The touched partitions as a scratch table and their bounds, in one job."""
    seen = Observation()
    touched = written(touched_partitions_frame(sl, spec).observe(seen, *bounds_of(spec)), "touched")
    return touched, read_bounds(seen.get, spec)


def _scope_folders(touched: DataFrame, spec: TableSpec) -> set[str]:
    """Folder names of the touched partitions, which the driver renames one by one; NULL's too where it is allowed."""
    pc = spec.partition_column
    names = touched.select(scope_value(F.col("partition_key"), spec, True).cast("string")).collect()
    return {f"{pc}={r[0]}" for r in names} | ({f"{pc}={NULL_FOLDER}"} if spec.null_partition == "allow" else set())


@dataclass
class _Staged:
    """What a commit does with the staged partition folders: new ones, those in scope, those that are emptied."""
    new: list[str]
    replace: list[str]
    add: list[str]
    gone: list[str]


def _sorted_out(spark: SparkSession, staged: str, there: set[str], touched: DataFrame, spec: TableSpec) -> _Staged:
    new, scope = folders(spark, staged), _scope_folders(touched, spec)
    replace = [d for d in new if d in scope or d not in there]
    return _Staged(new, replace, [d for d in new if d not in replace], sorted((scope - set(new)) & there))


def run_upsert(spark: SparkSession, raw: DataFrame, snapshot_path: str, spec: TableSpec,
               load: LoadSpec, start_run_id: str | None, end_run_id: str | None,
               columns: Sequence[str] | None = None, whole_table: bool = False,
               staging_root: str | None = None) -> UpsertResult:
    """Merge one window of ``raw`` into the parquet snapshot at ``snapshot_path``.

    The snapshot is partitioned by ``spec.partition_column`` (derived from the
    partition field) when the spec has a partition field. The first run creates it.
    """
    snapshot_path = snapshot_path.rstrip("/")
    recover(spark, snapshot_path)
    root = staging_root or snapshot_path + "_staging"
    staged = f"{root}/{uuid.uuid4().hex[:12]}"
    sl = source_slice(raw, spec, load, start_run_id, end_run_id, whole_table)
    src = latest(sl, spec.primary_keys, spec.ordering, spec.dedup)
    pc, exists = spec.partition_column, _exists(spark, snapshot_path)
    if exists:
        target = spark.read.parquet(snapshot_path)
    else:
        cols = list(columns or src.columns)
        empty_pc = partition_value(F.lit(None).cast("timestamp_ntz"), spec.partition_unit).alias(pc) if pc else None
        target = src.select(*cols, *([empty_pc] if pc else [])).limit(0)
    data_cols = [c for c in target.columns if c != pc]

    touched, bounds = _touched(sl, spec) if spec.partition_field else (None, None)
    if exists and (spec.rewrite == "files" or not spec.partition_field):
        return _upsert_files(spark, snapshot_path, target, written(src, "slice"), spec, columns, staged, touched, bounds)
    inside = split_scope(target, spec, touched, bounds)[0] if spec.partition_field else target
    counts = _write_parts(merge_rows(inside.select(*data_cols), src, spec, columns, INSERTED), staged, spec)
    new, note = folders(spark, staged), _noted(spark, staged, snapshot_path, counts)
    if not exists:
        commit(spark, snapshot_path, replace=[(staged, snapshot_path)], add=note, drop=[staged, note[0][0]], there=set())
        return UpsertResult(new, len(new) if pc else 1, snapshot_path, inserted=counts["records"])
    there = set(folders(spark, snapshot_path))
    todo = _sorted_out(spark, staged, there, touched, spec)
    at = lambda d: f"{snapshot_path}/{d}"
    commit(spark, snapshot_path, [(f"{staged}/{d}", at(d)) for d in todo.replace], [at(d) for d in todo.gone],
           [*note, *[(f"{staged}/{d}", at(d)) for d in todo.add]], drop=[staged, note[0][0]], there={at(d) for d in there})
    return UpsertResult(todo.new, len(todo.new), snapshot_path, inserted=counts["records"])


INSERTED = "__inserted"


def _write_parts(merged: DataFrame, staged: str, spec: TableSpec) -> dict[str, int]:
    """Write rows under their partitions, and count what is new on the way. ``rebalance`` co-locates the rows of one
    partition, and lets AQE split a hot one (one day holding a third of the rows) over several tasks and files."""
    pc, seen = spec.partition_column, Observation()
    if spec.partition_field:
        merged = merged.withColumn(pc, partition_value(F.col(spec.partition_field), spec.partition_unit)).hint("rebalance", pc)
    merged = merged.observe(seen, *load_metrics(merged, spec.primary_keys, of=F.col(INSERTED))).drop(INSERTED)
    w = merged.write.mode("overwrite")
    (w.partitionBy(pc) if spec.partition_field else w).parquet(staged)
    return seen.get


def _noted(spark: SparkSession, staged: str, path: str, counts: dict[str, int]) -> list[tuple[str, str]]:
    """The load's counts as one more staged file, which joins the table's notes in the same commit (``audit_of_loads``)."""
    note_load(spark, f"{staged}_load", counts)
    return [(f"{staged}_load", loads_path(path))]


def files_with_keys(target: DataFrame, src: DataFrame, spec: TableSpec, touched: DataFrame | None = None,
                    bounds: Bounds | None = None) -> list[str]:
    """Files of ``target`` (in scope) that hold a key of the deduplicated slice: a scan of the key columns only, semi-joined with the slice."""
    marked = target.withColumn("__file", F.col("_metadata.file_path"))
    inside = split_scope(marked, spec, touched, bounds)[0] if spec.partition_field else marked
    keys = source_keys(src, spec)
    held = inside.select("__file", *[q(k).alias(f"__tk{i}") for i, k in enumerate(spec.primary_keys)])
    same = [F.col(f"__tk{i}") == F.col(f"__sk{i}") for i in range(len(spec.primary_keys))]
    return sorted(r[0] for r in held.join(keys, same, "left_semi").select("__file").distinct().collect())


def _upsert_files(spark: SparkSession, path: str, target: DataFrame, src: DataFrame, spec: TableSpec, columns: Sequence[str] | None,
                  staged: str, touched: DataFrame | None, bounds: Bounds | None) -> UpsertResult:
    """Copy-on-write by file: rows of the files that hold a key of the slice are merged and written anew, and these
    files taken away in the same commit. No other row in scope can match, so the rest stays untouched."""
    hit = files_with_keys(target, src, spec, touched, bounds)
    data_cols = [c for c in target.columns if c != spec.partition_column]
    names = [unquote(f) for f in hit]
    old = spark.read.schema(target.schema).option("basePath", path).parquet(*names) if hit else target.limit(0)
    counts = _write_parts(merge_rows(old.select(*data_cols), src, spec, columns, INSERTED), staged, spec)
    new, note = folders(spark, staged), _noted(spark, staged, path, counts)
    add = [(f"{staged}/{d}", f"{path}/{d}") for d in new] if spec.partition_field else [(staged, path)]
    commit(spark, path, remove=names, add=[*note, *add], drop=[staged, note[0][0]], there=set(names))
    return UpsertResult(new, len(new) if spec.partition_field else 1, path, files=names, inserted=counts["records"])


def _table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def run_upsert_bucketed(spark: SparkSession, raw: DataFrame, table: str, spec: TableSpec, load: LoadSpec,
                        start_run_id: str | None, end_run_id: str | None, path: str | None = None,
                        columns: Sequence[str] | None = None, whole_table: bool = False) -> UpsertResult:
    """``run_upsert`` on a catalog table bucketed by the primary keys.

    The snapshot is read as a bucketed scan, already hash-partitioned on the keys,
    so the merge join never shuffles it; only the deduplicated slice (one row per
    key) is repartitioned into the bucket count. New partitions are written to a
    folder of this run with the same bucket layout, and each partition of the table is pointed
    at its new folder by one catalog statement; the old folders go after the commit.
    """
    if not (spec.buckets and spec.partition_field and spec.partition_column):
        raise ValueError("run_upsert_bucketed needs buckets, partition_field and partition_column")
    keys, pc, n = list(spec.primary_keys), spec.partition_column, spec.buckets
    sl = source_slice(raw, spec, load, start_run_id, end_run_id, whole_table)
    src = latest(sl, keys, spec.ordering, spec.dedup)
    # one small shuffle of the deduplicated slice into the snapshot's buckets
    src_b = src.repartition(n, *[F.col(k) for k in keys])

    def write_bucketed(df: DataFrame, name: str, location: str, mode: str) -> None:
        (df.write.mode(mode).format("parquet").partitionBy(pc).bucketBy(n, *keys).sortBy(*keys)
           .option("path", location).saveAsTable(name))

    if not spark.catalog.tableExists(table):
        cols = list(columns or src.columns)
        empty = src.select(*cols).limit(0).withColumn(pc, partition_value(F.col(spec.partition_field),
                                                                          spec.partition_unit))
        write_bucketed(empty, table, path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{table}",
                       "errorifexists")
    location = _table_location(spark, table).rstrip("/")
    if recover(spark, location):
        spark.catalog.refreshTable(table)
    target = spark.table(table)
    data_cols = [c for c in target.columns if c != pc]

    touched, bounds = _touched(sl, spec)
    inside, _rest = split_scope(target, spec, touched, bounds)
    merged = merge_rows(inside.select(*data_cols), src_b, spec, columns)
    merged = merged.withColumn(pc, partition_value(F.col(spec.partition_field), spec.partition_unit))
    staging = f"{table}__staging_{uuid.uuid4().hex[:10]}"
    staged = f"{location}_versions/{uuid.uuid4().hex[:12]}"
    write_bucketed(merged, staging, staged, "errorifexists")
    spark.sql(f"DROP TABLE {staging}")  # external: the files stay for the commit
    there = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    todo = _sorted_out(spark, staged, there, touched, spec)
    before = {d: _partition_location(spark, table, d) for d in [*todo.replace, *todo.add, *todo.gone] if d in there}
    point = [(table, _partition_spec(d), f"{staged}/{d}", before.get(d)) for d in todo.replace]
    point += [(table, _partition_spec(d), None, before[d]) for d in todo.gone]
    commit(spark, location, add=[(f"{staged}/{d}", before[d]) for d in todo.add], point=point,
           drop=[before[d] for d in [*todo.replace, *todo.gone] if d in before])
    spark.catalog.refreshTable(table)
    return UpsertResult(todo.new, len(todo.new), location)


def _partition_spec(folder: str) -> str:
    name, value = folder.split("=", 1)
    return f"`{name}` = " + ("NULL" if value == NULL_FOLDER else f"'{value}'")


def _partition_location(spark: SparkSession, table: str, folder: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({_partition_spec(folder)})").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").rstrip("/")

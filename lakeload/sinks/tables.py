"""Sinks, table creation and schema evolution.

Writes are plain DataFrameWriter calls. Partitioned appends ``rebalance`` on the
partition column first: rows of one partition are co-located (few files per
partition) while AQE may still split a hot partition over several tasks.
Overwrites of a path are staged in a fresh folder and committed by a rename, so a plan never
overwrites the files it reads. Appends are staged as well, each load in a folder of its own within the table,
so that several may join one table at the same time.
"""

from __future__ import annotations

import json
import threading
import uuid
from typing import Iterator, Mapping, Sequence

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import partition_value
from ..operators.audit import load_metrics, loads_path
from ..session import hadoop_fs
from ..spec import spark_type
from .commit import Store, commit, recover
from .commit import folders as _folders_in


def partition_column_name(field: str) -> str:
    return f"{field}_part"


def with_partition(df: DataFrame, field: str | None, unit: str | None) -> tuple[DataFrame, list[str]]:
    if not field or not unit:
        return df, []
    pc = partition_column_name(field)
    return df.withColumn(pc, partition_value(F.col(field), unit)), [pc]


def _layout(df: DataFrame, parts: Sequence[str], cluster: Sequence[str] | str | None) -> DataFrame:
    cl = [c.strip() for c in cluster.split(",")] if isinstance(cluster, str) else list(cluster or [])
    if parts:
        df = df.hint("rebalance", *parts)
    if cl:
        df = df.sortWithinPartitions(*parts, *cl)
    return df


# Formats whose table is just its files; other formats commit appends by themselves.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")
LOAD = "_load"             # prefix of a load's staging folder within the table; readers skip it


def append_raw(df: DataFrame, path: str, partition_field: str | None = None, partition_unit: str | None = None,
               cluster: Sequence[str] | str | None = None, fmt: str = "parquet", audit_keys: Sequence[str] | None = None) -> None:
    """K1: append to a raw table, partitioned by the truncated time field and
    clustered (sorted within files, giving min/max skipping on the cluster keys).

    The files are written to a folder of this load and join the table when all are there. Spark's own append would have
    all writers of a table share one ``_temporary`` folder, which goes with the first one that ends: the others fail, or
    lose rows.

    With ``audit_keys`` the job that writes also counts its rows, and leaves a note for ``audit_of_loads``; a load that
    ends between rows and note has none, and its table needs ``audit_tables``.
    """
    out, parts = with_partition(df, partition_field, partition_unit)
    out, seen = _layout(out, parts, cluster), Observation()
    if audit_keys is not None:
        out = out.observe(seen, *load_metrics(out, audit_keys))
    w = out.write.mode("append").format(fmt)
    if parts:
        w = w.partitionBy(*parts)
    if fmt in FILE_FORMATS:
        staged = f"{path.rstrip('/')}/{LOAD}_{uuid.uuid4().hex[:12]}"
        store = Store(df.sparkSession, path)
        try:
            w.save(staged)
            _join_table(store, staged, path.rstrip("/"))
        finally:
            store.delete(staged)
    else:
        w.save(path)
    if audit_keys is not None:
        note_load(df.sparkSession, loads_path(path), seen.get)


def _join_table(store: Store, staged: str, table: str) -> None:
    """Move a load's files to the same places of the table, or none of them if a move fails. Their names hold the id of
    the job that wrote them, so no other load has the same ones."""
    moves, todo = [], [""]
    while todo:
        below = todo.pop()
        for f in store.fs.listStatus(store._path(staged + below)):
            name = f.getPath().getName()
            if f.isDirectory():
                todo.append(f"{below}/{name}")
            elif not name.startswith(("_", ".")):
                moves.append((f"{staged}{below}/{name}", f"{table}{below}/{name}"))
    made = []
    try:
        for a, b in moves:
            store.rename(a, b)
            made.append((a, b))
    except Exception:
        for a, b in reversed(made):
            store.rename(b, a)
        raise
    store.write(f"{table}/_SUCCESS", "")


def note_load(spark: SparkSession, folder: str, metrics: Mapping[str, int]) -> None:
    """One load's counts as a small JSON file of its own."""
    load = uuid.uuid4().hex[:12]
    fs, _ = hadoop_fs(spark, folder)
    out = fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{load}.json"), False)
    out.write(bytearray(json.dumps({"load_id": load, **metrics}).encode()))
    out.close()


def pick_clustering(table_cfg: Mapping | None, common_cfg: Mapping) -> Sequence[str] | str | None:
    """K1: table-level clustering only when ``USE_CLUSTERING_FOR_RAW == "True"``."""
    if table_cfg and table_cfg.get("USE_CLUSTERING_FOR_RAW") == "True":
        return table_cfg.get("CLUSTERING_FIELDS")
    return common_cfg.get("CLUSTERING_FIELDS")


def check_additive(old: T.DataType, new: T.DataType, path: str = "") -> T.DataType:
    """K2/K3: the widened type of a table when a batch of type ``new`` is appended: fields
    may be added at any depth; a field that both have must keep its type."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        known = {f.name: f for f in old.fields}
        added = [f for f in new.fields if f.name not in known]
        later = {f.name: f.dataType for f in new.fields}
        kept = [T.StructField(f.name, check_additive(f.dataType, later[f.name], f"{path}{f.name}.") if f.name in later
                              else f.dataType, True) for f in old.fields]
        return T.StructType(kept + [T.StructField(f.name, f.dataType, True) for f in added])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(check_additive(old.elementType, new.elementType, path), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(check_additive(old.keyType, new.keyType, path), check_additive(old.valueType, new.valueType, path), True)
    if old != new:
        raise ValueError(f"field {path.rstrip('.')} is {old.simpleString()} in the table and {new.simpleString()} in the batch")
    return old


SCHEMA_LOG = "_schema"     # folder of numbered versions; readers of data files skip names with a leading underscore
_claiming = threading.Lock()


def _schema_version(spark: SparkSession, path: str) -> tuple[int, T.StructType | None]:
    """The latest version of the table's widened schema and its number: 0 for a table without a log, whose schema comes
    from its data (None for one without any)."""
    fs, log = hadoop_fs(spark, f"{path.rstrip('/')}/{SCHEMA_LOG}")
    names = [f.getPath().getName() for f in fs.listStatus(log)] if fs.exists(log) else []
    numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
    if numbers:
        stream = fs.open(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(log, f"{max(numbers):08d}.json"))
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return max(numbers), T.StructType.fromJson(json.loads(text))
    table = log.getParent()
    if fs.exists(table) and any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(table)):
        return 0, spark.read.option("mergeSchema", "true").parquet(path).schema
    return 0, None


def _claim_version(spark: SparkSession, path: str, number: int, schema: T.StructType) -> bool:
    """Put version ``number`` in place unless another writer has: written beside, then renamed to a name that must not
    exist. The store's rename decides between writers; on a local disk, where it would overwrite, this process's lock."""
    fs, log = hadoop_fs(spark, f"{path.rstrip('/')}/{SCHEMA_LOG}")
    jvm = spark.sparkContext._jvm
    fs.mkdirs(log)
    part, file = jvm.org.apache.hadoop.fs.Path(log, f".{uuid.uuid4().hex}.part"), jvm.org.apache.hadoop.fs.Path(log, f"{number:08d}.json")
    out = fs.create(part)
    out.write(bytearray(schema.json().encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(file).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        with _claiming:
            context.rename(fs.makeQualified(part), fs.makeQualified(file), keep)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        fs.delete(part, False)
        return False


def evolve_schema(spark: SparkSession, path: str, new: T.StructType) -> T.StructType:
    """The table's schema widened by ``new``, as a version of its log that holds what all other writers have added so far.
    A changed type raises and leaves the log as it is."""
    new = T.StructType([T.StructField(f.name, f.dataType, True) for f in new.fields])
    while True:
        number, old = _schema_version(spark, path)
        widened = new if old is None else check_additive(old, new)
        if number and widened == old or _claim_version(spark, path, number + 1, widened):
            return widened


def append_with_new_fields(df: DataFrame, path: str, partition_field: str | None = None,
                           partition_unit: str | None = None, **kw) -> None:
    """K2: append a batch that may bring new top-level columns. The batch is compared with
    the table's schema before anything is written; a changed type raises, nested ones
    too. The widened schema goes to the table's log before the rows, so no row is ever in the table whose
    columns readers do not know; a load that ends in between leaves columns that are NULL."""
    whole, _ = with_partition(df, partition_field, partition_unit)
    evolve_schema(df.sparkSession, path, whole.schema)
    append_raw(df, path, partition_field, partition_unit, **kw)


def append_with_new_struct_fields(df: DataFrame, path: str, **kw) -> None:
    """K3: the same for batches whose structs (also within arrays and maps) bring new members."""
    append_with_new_fields(df, path, **kw)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """Read with the widened schema (older rows have NULL in later columns and members)."""
    return spark.read.schema(_schema_version(spark, path)[1]).parquet(path)


def union_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """K2/K3 in-plan: union that widens top-level columns and nested structs."""
    return old.unionByName(new, allowMissingColumns=True)


def create_table_as(spark: SparkSession, df: DataFrame, table: str, path: str | None = None,
                    partition_field: str | None = None, partition_unit: str | None = "",
                    cluster: Sequence[str] | str | None = "", fmt: str = "parquet") -> DataFrame:
    """K4: create a table from a query; partitioning and clustering each skipped
    when configured as ``''``. Fails if the table exists."""
    out, parts = with_partition(df, partition_field or None, partition_unit or None)
    w = _layout(out, parts, cluster or None).write.mode("errorifexists").format(fmt)
    if parts:
        w = w.partitionBy(*parts)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return spark.table(table)


def full_load(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet",
              partition_by: Sequence[str] = ()) -> None:
    """K5: replace the destination with the query result (staged, then committed; see ``sinks/commit.py``)."""
    recover(spark, path)
    staged = f"{path.rstrip('/')}_staging_{uuid.uuid4().hex[:12]}"
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(staged)
    commit(spark, path, replace=[(staged, path.rstrip("/"))])


def create_empty(spark: SparkSession, schema: T.StructType | str, table: str, path: str | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """K6: an empty table with a declared (possibly nested) schema."""
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    w = spark.createDataFrame([], st).write.mode("errorifexists").format(fmt)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return spark.table(table)


def add_columns(spark: SparkSession, table: str, columns: Mapping[str, str]) -> DataFrame:
    """K7: append columns to a table's schema, then verify the new column count."""
    before = len(spark.table(table).columns)
    cols = ", ".join(f"`{n}` {spark_type(t)}" for n, t in columns.items())
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
    spark.catalog.refreshTable(table)
    after = spark.table(table)
    if len(after.columns) != before + len(columns):
        raise RuntimeError(f"{table}: the added columns are not in the table's schema")
    return after


def copy_table(spark: SparkSession, source_fmt: str, source_options: Mapping[str, str], sink_fmt: str,
               sink_options: Mapping[str, str], mode: str = "overwrite", check_data: bool = False,
               query: str | None = None, preview_rows: int = 20) -> int | None:
    """K8: connector read -> connector write. With ``check_data`` the frame is
    persisted, counted and previewed before the write, and released after it."""
    from ..sources.connectors import scan_connector

    df = scan_connector(spark, source_fmt, source_options, query)
    count = None
    if check_data:
        df = df.persist()
        count = df.count()
        if preview_rows:
            df.show(preview_rows, truncate=False)
    try:
        df.write.format(sink_fmt).mode(mode).options(**sink_options).save()
    finally:
        if check_data:
            df.unpersist()
    return count


# Text formats that keep microseconds (Spark's defaults cut to millis).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TEXT_TIME_OPTIONS = {"timestampFormat": TS_FORMAT, "timestampNTZFormat": TS_NTZ_FORMAT}


def export_csv(df: DataFrame, path: str, header: bool = True, delimiter: str = ",",
               single_file: bool = False) -> None:
    """K9: write a query result as CSV (one file only when asked); times keep
    microseconds."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").options(**TEXT_TIME_OPTIONS)
        .option("header", str(header).lower()).option("sep", delimiter).csv(path))


def read_csv_export(spark: SparkSession, path: str, schema, header: bool = True,
                    delimiter: str = ",") -> DataFrame:
    """Read back a K9 export with the same time formats."""
    return (spark.read.schema(schema).options(**TEXT_TIME_OPTIONS)
            .option("header", str(header).lower()).option("sep", delimiter).csv(path))


def write_delimited(df: DataFrame, path: str, delimiter: str = "|", header_rows: int = 0,
                    header_text: str | None = None) -> None:
    """Delimited text with ``header_rows`` leading lines in every file (the layout
    ``scan_delimited`` reads). Each task writes one file; the header lines are
    emitted ahead of its rows inside the task, in Arrow batches."""
    text_cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    lines = df.select(F.concat_ws(delimiter, *text_cols).alias("value"))
    header = header_text if header_text is not None else delimiter.join(df.columns)

    def add_header(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = True
        for b in batches:
            if first:
                yield pd.DataFrame({"value": [header] * header_rows})
                first = False
            yield b
        if first:
            yield pd.DataFrame({"value": [header] * header_rows})

    if header_rows:
        lines = lines.mapInPandas(add_header, "value string")
    lines.write.mode("overwrite").text(path)


MANIFEST = "_moved"


def relayout_history(spark: SparkSession, source: str, target: str, table: str, fmt: str = "parquet",
                     date_col: str = "snapshot_date") -> DataFrame:
    """History files under ``…/<table>_yyyyMMdd/…`` folders rewritten as a hive
    tree partitioned by the date. The source is only read, never deleted.

    A manifest in ``<target>/_moved`` holds each source file with its size and time, by date. A run lists the source,
    compares it with the manifest, and rewrites the dates whose files are not the same as then: a second run writes
    nothing. Data and manifest of a date are committed together (``sinks/commit.py``).
    """
    from ..sources.inventory import file_inventory

    target = target.rstrip("/")
    recover(spark, target)
    pattern = table + r"_(\d{8})(?:/|$)"
    date_of = lambda c: F.try_to_timestamp(F.regexp_extract(c, pattern, 1), F.lit("yyyyMMdd")).cast("date")
    found = file_inventory(spark, source).where(~F.col("name").rlike("^[_.]"))
    found = found.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"), date_of(F.col("path")).alias(date_col))
    there = set(_folders_in(spark, target))
    key = ["file", "length", "modified", date_col]
    if there:
        moved = spark.read.schema(found.schema).parquet(f"{target}/{MANIFEST}")
        a, b = found.alias("a"), moved.alias("b")
        fresh = a.join(b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in key], "left_anti").select(date_col)
        lost = b.join(a, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in key], "left_anti").select(date_col)
        dates = [r[0] for r in fresh.unionByName(lost).distinct().collect()]
        if not dates:
            return spark.read.format(fmt).load(target)
        changed = F.col(date_col).isin([d for d in dates if d]) | (F.col(date_col).isNull() if None in dates else F.lit(False))
        found = found.where(changed)
        patterns = [f"{table}_{d:%Y%m%d}" for d in dates if d]
    staged = f"{target}_staging/{uuid.uuid4().hex[:12]}"
    df = spark.read.format(fmt).option("recursiveFileLookup", "true").load(source)
    dated = df.withColumn(date_col, date_of(F.col("_metadata.file_path")))
    if there:
        # names of files come from the file listing, so other dates' files are skipped before they are opened
        wanted = F.regexp_extract(F.col("_metadata.file_path"), "(" + table + r"_\d{8})(?:/|$)", 1).isin(patterns)
        dated = dated.where(wanted | F.col(date_col).isNull() if None in dates else wanted)
    dated.hint("rebalance", date_col).write.mode("overwrite").format(fmt).partitionBy(date_col).save(staged)
    found.hint("rebalance", date_col).write.mode("overwrite").partitionBy(date_col).parquet(f"{staged}/{MANIFEST}")
    if not there:
        commit(spark, target, replace=[(staged, target)], drop=[staged])
    else:
        name = lambda d: f"{date_col}={d.isoformat() if d else '__HIVE_DEFAULT_PARTITION__'}"
        new, noted = set(_folders_in(spark, staged)), set(_folders_in(spark, f"{staged}/{MANIFEST}"))
        commit(spark, target, [(f"{staged}/{d}", f"{target}/{d}") for d in sorted(new)]
               + [(f"{staged}/{MANIFEST}/{d}", f"{target}/{MANIFEST}/{d}") for d in sorted(noted)],
               [f"{target}/{d}" for d in map(name, dates) if d not in new] + [f"{target}/{MANIFEST}/{d}" for d in map(name, dates) if d not in noted],
               drop=[staged])
    return spark.read.format(fmt).load(target)


def table_schema(spark: SparkSession, df_or_table) -> DataFrame:
    """Column -> type as a frame, names lower-cased."""
    df = spark.table(df_or_table) if isinstance(df_or_table, str) else df_or_table
    rows = [(f.name.lower(), f.dataType.simpleString(), i + 1) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "column_name string, data_type string, ordinal_position int")


def table_exists(spark: SparkSession, table: str) -> bool:
    """Existence test."""
    return spark.catalog.tableExists(table)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Table names of a database as a frame."""
    names = [(t.name, t.database, t.tableType) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(names, "table_name string, database string, table_type string")

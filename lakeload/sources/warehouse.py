"""A warehouse as a Spark data source (S6, K8): format ``lakeload_warehouse``.

The warehouse is a folder of parquet tables that a SQL engine of its own (DuckDB, within the task) answers queries
on, as a warehouse connector's remote side does: the source query runs there, Spark receives Arrow batches of its result
while the engine makes them. What a task holds does not grow with the rows it reads: the engine works within ``TASK_MEMORY``
and puts what is beyond (one side of a join, groups, sorted rows) on the task's own disk.

Options: ``database`` (the folder, which driver and executors share), ``query`` or ``dbtable``; for a read in parts
``partitionColumn`` (a whole number) and ``numPartitions``, cut at equal ranges of its values, NULL in the first; for a
write ``dbtable``. Filters that Spark hands over are added to the source query, so the engine drops the rows.

A write is committed by the driver: each task writes one file to a folder of this write and reports it; when all tasks
have succeeded the files become the table (or join it, in append mode), else the folder goes.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

FORMAT = "lakeload_warehouse"
BATCH_ROWS = 10_000
TASK_MEMORY = "300MB"        # of the engine within one task; an executor's tasks have as much each at a time
OPERATORS = {ds.EqualTo: "=", ds.GreaterThan: ">", ds.GreaterThanOrEqual: ">=", ds.LessThan: "<", ds.LessThanOrEqual: "<=",
             ds.EqualNullSafe: "IS NOT DISTINCT FROM"}


def register(spark: SparkSession) -> str:
    """Make the format known to the session; its name. Spark asks Python sources about filters only with the setting on."""
    spark.dataSource.register(WarehouseSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return FORMAT


def _folder(options) -> str:
    if not options.get("database"):
        raise ValueError("the warehouse needs the option 'database'")
    return options["database"].removeprefix("file://").rstrip("/")


@contextmanager
def _connect(folder: str):
    """The engine with a view per table of the folder, and a place of its own on disk."""
    import duckdb
    with tempfile.TemporaryDirectory(prefix="lakeload-warehouse-") as spill, \
            duckdb.connect(config={"threads": 1, "memory_limit": TASK_MEMORY, "temp_directory": spill}) as con:
        for name in sorted(os.listdir(folder)):
            table, ending = os.path.splitext(name)
            if ending == ".parquet" and not name.startswith(("_", ".")):
                at = f"{folder}/{name}" + ("/*.parquet" if os.path.isdir(f"{folder}/{name}") else "")
                con.execute(f"CREATE VIEW {_name(table)} AS SELECT * FROM read_parquet('{at}')")
        yield con


def _name(column: str) -> str:
    return '"' + column.replace('"', '""') + '"'


def _query(options) -> str:
    if options.get("query"):
        return options["query"]
    if options.get("dbtable"):
        return f"SELECT * FROM {_name(options['dbtable'])}"
    raise ValueError("the warehouse needs the option 'query' or 'dbtable'")


def condition(f: ds.Filter) -> tuple[str, list] | None:
    """A filter as SQL with its values, or None if Spark has to apply it."""
    if isinstance(f, ds.Not):
        inner = condition(f.child)
        return inner and (f"NOT ({inner[0]})", inner[1])
    column = _name(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
    if column is None:
        return None
    if isinstance(f, (ds.IsNull, ds.IsNotNull)):
        return f"{column} IS {'NOT ' * isinstance(f, ds.IsNotNull)}NULL", []
    if isinstance(f, ds.In):
        return f"{column} IN ({', '.join('?' * len(f.value))})", list(f.value)
    if type(f) in OPERATORS:
        return f"{column} {OPERATORS[type(f)]} ?", [f.value]
    return None


@dataclass
class Part(ds.InputPartition):
    where: str = ""
    values: list = field(default_factory=list)

    def __init__(self, where: str = "", values: Sequence = ()):
        super().__init__(where)
        self.where, self.values = where, list(values)


class WarehouseReader(ds.DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.folder, self.query, self.schema = _folder(options), _query(options), to_arrow_schema(schema)
        self.column, self.parts = options.get("partitionColumn"), int(options.get("numPartitions") or 1)
        self.pushed: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for f in filters:
            found = condition(f)
            if found is None:
                yield f
            else:
                self.pushed.append(found)

    def partitions(self) -> Sequence[ds.InputPartition]:
        if not self.column or self.parts < 2:
            return [Part()]
        c = _name(self.column)
        with _connect(self.folder) as con:
            low, high = con.execute(f"SELECT min({c}), max({c}) FROM ({self.query}) q").fetchone()
        if low is None:
            return [Part()]
        edges = [low + (high + 1 - low) * i // self.parts for i in range(self.parts + 1)]
        parts = [Part(f"{c} >= ? AND {c} < ?", (a, b)) for a, b in zip(edges, edges[1:]) if a < b]
        parts[0].where = f"({parts[0].where} OR {c} IS NULL)"
        return parts

    def statement(self, part: Part) -> tuple[str, list]:
        terms = [part.where] * bool(part.where) + [sql for sql, _ in self.pushed]
        values = part.values + [v for _, own in self.pushed for v in own]
        return f"SELECT * FROM ({self.query}) q" + (" WHERE " + " AND ".join(terms) if terms else ""), values

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        sql, values = self.statement(partition)
        with _connect(self.folder) as con:
            # a relation's rows come as they are made; execute() would first hold the whole result, whatever the limit
            for batch in con.sql(sql, params=values).to_arrow_reader(BATCH_ROWS):
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(batch.columns, self.schema)], schema=self.schema)


@dataclass
class Written(ds.WriterCommitMessage):
    file: str
    rows: int


class WarehouseWriter(ds.DataSourceArrowWriter):
    def __init__(self, options, schema: T.StructType, overwrite: bool):
        if not options.get("dbtable"):
            raise ValueError("a write needs the option 'dbtable'")
        self.schema, self.overwrite = to_arrow_schema(schema), overwrite
        self.table = f"{_folder(options)}/{options['dbtable']}.parquet"
        self.staged = f"{_folder(options)}/_write_{uuid.uuid4().hex[:12]}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        os.makedirs(self.staged, exist_ok=True)
        file, rows = f"{self.staged}/part-{uuid.uuid4().hex}.parquet", 0
        with pq.ParquetWriter(file, self.schema) as out:
            for batch in iterator:
                out.write_batch(pa.RecordBatch.from_arrays(batch.columns, schema=self.schema))
                rows += batch.num_rows
        return Written(file, rows)

    def commit(self, messages: list[Written | None]) -> None:
        """Only files that a task has reported become part of the table: those of failed or repeated tasks do not."""
        files = [m.file for m in messages if m is not None]
        if not files:
            files = [self.write(iter(())).file]
        before = [] if not os.path.isdir(self.table) else os.listdir(self.table)
        if self.overwrite and os.path.isfile(self.table):
            os.remove(self.table)
        os.makedirs(self.table, exist_ok=True)
        for f in files:
            os.rename(f, f"{self.table}/{os.path.basename(f)}")
        if self.overwrite:
            for name in before:
                os.remove(f"{self.table}/{name}")
        shutil.rmtree(self.staged, ignore_errors=True)

    def abort(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.staged, ignore_errors=True)


class WarehouseSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        with _connect(_folder(self.options)) as con:
            found = con.execute(f"SELECT * FROM ({_query(self.options)}) q LIMIT 0").to_arrow_reader().schema
        return from_arrow_schema(found, prefer_timestamp_ntz=True)

    def reader(self, schema: T.StructType) -> WarehouseReader:
        return WarehouseReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarehouseWriter:
        return WarehouseWriter(self.options, schema, overwrite)

"""

    scan (every column STRING, typed ingestion key from the hive folder)
    -> 'NULL' text to NULL, try_cast to the schema types -> audit columns
    -> partitioned, clustered append

The only action is the append itself.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.project import add_audit_columns, clean_name, safe_cast_all, schema_fields
from ..sinks.tables import append_raw
from ..sources.files import scan_delimited, scan_ndjson, scan_parquet

INGESTION_KEY = "last_ingestion_utc_time"


def _typed(schema_json, key: str, key_type: str) -> list[tuple[str, str]]:
    return schema_fields(schema_json) + [(key, key_type)]


def land_delimited(spark: SparkSession, source: str, raw_path: str, schema_json, delimiter: str = "|",
                   header_rows: int = 0, audit_exprs: Sequence[str] = (), source_timezone: str = "PST8PDT",
                   partition_field: str | None = None, partition_unit: str | None = None,
                   cluster: Sequence[str] | str | None = None, key: str = INGESTION_KEY,
                   key_type: str = "TIMESTAMP", write: bool = True) -> DataFrame:
    """Delimited files under ``source`` (hive folders ``<key>=<value>``) -> raw table.
    Output order: schema columns, ingestion time, audit columns, source zone."""
    raw = scan_delimited(spark, source, schema_json, delimiter, header_rows, keys={key: key_type},
                         base_path=source)
    typed = safe_cast_all(raw, _typed(schema_json, key, key_type))
    cols = [clean_name(n) for n, _ in schema_fields(schema_json)]
    out = add_audit_columns(typed, audit_exprs, source_timezone, schema_cols=cols, ingestion_col=key)
    if write:
        append_raw(out, raw_path, partition_field, partition_unit, cluster)
    return out


def land_ndjson(spark: SparkSession, source: str, raw_path: str, schema_json, audit_exprs: Sequence[str] = (),
                source_timezone: str = "PST8PDT", partition_field: str | None = None,
                partition_unit: str | None = None, cluster: Sequence[str] | str | None = None,
                key: str = INGESTION_KEY, key_type: str = "TIMESTAMP", write: bool = True) -> DataFrame:
    """Newline JSON files -> raw table; only non-STRING columns are cast. Output
    order: schema columns, audit columns, source zone, ingestion time."""
    raw = scan_ndjson(spark, source, schema_json, keys={key: key_type}, base_path=source)
    typed = safe_cast_all(raw, schema_json, null_marker=False, only_non_text=True)
    cols = [n for n, _ in schema_fields(schema_json)]
    out = add_audit_columns(typed, audit_exprs, source_timezone, schema_cols=cols, ingestion_col=key,
                            layout="json")
    if write:
        append_raw(out, raw_path, partition_field, partition_unit, cluster)
    return out


def land_parquet(spark: SparkSession, source: str, raw_path: str, partition_field: str | None = None,
                 partition_unit: str | None = None, cluster: Sequence[str] | str | None = None,
                 write: bool = True) -> DataFrame:
    """Parquet files with hive keys -> raw table, as a plain load (no casts). New
    columns are allowed; readers merge schemas (``read_evolved``)."""
    out = scan_parquet(spark, source, base_path=source)
    if write:
        append_raw(out, raw_path, partition_field, partition_unit, cluster)
    return out

"""Projections, casts and predicates."""

from __future__ import annotations

import re
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import ntz_to_instant, partition_value, run_id_to_instant, run_id_to_utc_ntz
from ..spec import DEFAULT_ZONE, spark_type


def q(name: str) -> Column:
    """Column by exact name (names may hold dots or blanks)."""
    return F.col("`" + name.replace("`", "``") + "`")


def schema_fields(schema_json) -> list[tuple[str, str]]:
    """``{"schema": [{"name", "dataType"}]}`` (or a list of pairs) -> [(name, type)]."""
    if isinstance(schema_json, Mapping):
        return [(f["name"], f["dataType"]) for f in schema_json["schema"]]
    return [(n, t) for n, t in schema_json]


def is_text_type(type_name: str) -> bool:
    return type_name.upper() == "STRING" or "BLOB" in type_name.upper()


def clean_name(name: str) -> str:
    return name.replace(" ", "_")


def clean_names(df: DataFrame) -> DataFrame:
    """Blanks in column names become ``_``. Reserved words need no escape here:
    every column is referenced by exact, quoted name."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def null_literal(df: DataFrame, cols: Iterable[str], marker: str = "NULL") -> DataFrame:
    """The text ``'NULL'`` (case-sensitive) becomes a real NULL in the named columns."""
    cols = set(cols)
    return df.select(*[
        (F.when(q(c) == F.lit(marker), F.lit(None)).otherwise(q(c)).alias(c) if c in cols else q(c))
        for c in df.columns
    ])


# An explicit zone at the end of a time text: Z, an offset, or a region after the clock.
ZONE_SUFFIX = r"\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2})?|[A-Za-z]+/[A-Za-z_/]+)\s*$"


def try_instant(c: Column) -> Column:
    """``try_cast`` to an instant; a text that names no zone is read as UTC, whatever
    the session zone."""
    as_utc = ntz_to_instant(c.try_cast("timestamp_ntz"))
    plain = (F.typeof(c) == F.lit("string")) & ~c.cast("string").rlike(ZONE_SUFFIX)
    return F.when(plain, as_utc).otherwise(c.try_cast("timestamp"))


def safe_cast_all(df: DataFrame, schema_json, null_marker: bool = True,
                  only_non_text: bool = False) -> DataFrame:
    """``try_cast`` every schema column to its declared type; bad cells become NULL.

    ``null_marker`` applies P2 to STRING and *BLOB* columns first (delimited-file path);
    ``only_non_text`` casts only non-STRING columns (JSON path). Columns not in the
    schema pass through unchanged after the schema columns, in their order.
    """
    fields = schema_fields(schema_json)
    names = {clean_name(n) for n, _ in fields}
    out = []
    for name, typ in fields:
        c = q(clean_name(name))
        if null_marker and is_text_type(typ):
            c = F.when(c == F.lit("NULL"), F.lit(None)).otherwise(c)
        if not (only_non_text and typ.upper() == "STRING"):
            c = try_instant(c) if spark_type(typ) == "timestamp" else c.try_cast(spark_type(typ))
        out.append(c.alias(clean_name(name)))
    out += [q(c) for c in df.columns if c not in names]
    return df.select(*out)


def add_audit_columns(df: DataFrame, audit_exprs: Sequence[str], source_timezone: str,
                      schema_cols: Sequence[str] | None = None,
                      ingestion_col: str = "last_ingestion_utc_time",
                      layout: str = "csv") -> DataFrame:
    """Configured audit expressions, a ``source_timezone`` literal and the ingestion time.

    Output order for ``csv``: schema columns, ingestion time, audit, zone;
    for ``json``: schema columns, audit, zone, ingestion time. An empty audit list is fine.
    """
    schema_cols = [c for c in (schema_cols or df.columns) if c != ingestion_col]
    audit = [F.expr(e) for e in audit_exprs if e and e.strip()]
    zone = F.lit(source_timezone).alias("source_timezone")
    base = [q(c) for c in schema_cols]
    if layout == "csv":
        cols = base + [q(ingestion_col)] + audit + [zone]
    else:
        cols = base + audit + [zone, q(ingestion_col)]
    return df.select(*cols)


def strict_cast(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """P5: ANSI ``cast`` of the listed columns; a bad value fails the job."""
    return df.select(*[(q(c).cast(spark_type(casts[c])).alias(c) if c in casts else q(c))
                       for c in df.columns])


def window_bounds(df: DataFrame, audit_col: str, start_run_id: str, end_run_id: str,
                  zone: str = DEFAULT_ZONE) -> tuple[Column, Column]:
    """Bounds of a run window in the column's own flavour: an instant for
    ``timestamp`` columns, the UTC wall clock for ``timestamp_ntz`` columns."""
    dtype = df.schema[audit_col].dataType
    conv = run_id_to_utc_ntz if isinstance(dtype, T.TimestampNTZType) else run_id_to_instant
    return conv(start_run_id, zone), conv(end_run_id, zone)


def filter_window(df: DataFrame, audit_col: str, start_run_id: str, end_run_id: str,
                  zone: str = DEFAULT_ZONE, partition_column: str | None = None,
                  partition_unit: str = "DAY") -> DataFrame:
    """``audit BETWEEN start AND end``, both inclusive; bounds are run ids read in
    ``zone``. The bounds fold to literals, so the predicate reaches the parquet scan.

    When the table is partitioned by the truncated audit column (``partition_column``,
    as ``append_raw`` writes it), the truncated bounds also limit that column: a
    truncation is monotonic, so no row is lost, and the scan lists only the
    window's directories (``PartitionFilters``) instead of the whole raw table.
    """
    lo, hi = window_bounds(df, audit_col, start_run_id, end_run_id, zone)
    out = df.where(q(audit_col).between(lo, hi))
    if partition_column and partition_column in df.columns:
        out = out.where(q(partition_column).between(partition_value(lo, partition_unit),
                                                    partition_value(hi, partition_unit)))
    return out


def filter_extra(df: DataFrame, clause: str | None) -> DataFrame:
    """Optional user predicate (SQL text); nothing is applied when it is empty."""
    if clause and clause.strip():
        return df.where(F.expr(clause))
    return df


whole_table = filter_extra


def query_with_params(spark: SparkSession, sql: str, start_run_id: str, end_run_id: str,
                      **views: DataFrame) -> DataFrame:
    """SQL text with named string parameters ``:start_run_id`` / ``:end_run_id``
    (``@start_run_id`` as written for the warehouse is accepted too). Frames passed
    as keywords are usable by name inside the text."""
    sql = re.sub(r"@(start_run_id|end_run_id)\b", r":\1", sql)
    return spark.sql(sql, args={"start_run_id": start_run_id, "end_run_id": end_run_id}, **views)


def on_date(df: DataFrame, ts_col: str, day: str) -> DataFrame:
    """P10: ``date(ts) = day``."""
    return df.where(F.to_date(q(ts_col)) == F.lit(day).cast("date"))


def filter_in(df: DataFrame, key: str, ids, flag_col: str | None = None,
              flag_value: str = "N") -> DataFrame:
    """``key IN (ids) AND flag = value``. ``ids`` may be a list (literal IN) or a
    one-column DataFrame (left-semi join, any size)."""
    if isinstance(ids, DataFrame):
        other = ids.select(ids.columns[0]).toDF(key).distinct()
        out = df.join(other, on=key, how="left_semi")
    else:
        out = df.where(q(key).isin(list(ids)))
    if flag_col:
        out = out.where(q(flag_col) == F.lit(flag_value))
    return out


def keep_if_null(source_col: Column, target_col: Column) -> Column:
    """Keep the target value when the source value is NULL."""
    return F.coalesce(source_col, target_col)


def _struct_drop_paths(dtype: T.DataType, names: set, prefix: str) -> list[str]:
    paths = []
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            path = f"{prefix}.{f.name}" if prefix else f.name
            if f.name in names:
                paths.append(path)
            else:
                paths += _struct_drop_paths(f.dataType, names, path)
    return paths


def drop_fields_recursive(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Remove the named keys at every nesting level of struct columns (arrays are
    not entered), driven by the schema; NULL structs stay NULL."""
    names = set(names)
    out = []
    for f in df.schema.fields:
        if f.name in names:
            continue
        paths = _struct_drop_paths(f.dataType, names, "")
        c = q(f.name)
        if paths:
            c = c.dropFields(*paths).alias(f.name)
        out.append(c)
    return df.select(*out)

"""Table and load specifications, and the warehouse-to-Spark type map."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Mapping

# Warehouse type names as they appear in schema files, and the
# Spark SQL type each one becomes.
TYPE_MAP = {
    "STRING": "string",
    "INT64": "bigint",
    "INTEGER": "bigint",
    "INT": "bigint",
    "FLOAT64": "double",
    "FLOAT": "double",
    "NUMERIC": "decimal(38,9)",
    "BIGNUMERIC": "decimal(38,18)",
    "BOOL": "boolean",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
    "DATETIME": "timestamp_ntz",
    "BYTES": "binary",
}

PARTITION_UNITS = ("HOUR", "DAY", "MONTH", "YEAR")
DEFAULT_ZONE = "PST8PDT"
RUN_ID_FORMAT = "yyyyMMddHHmmss"
NULL_PARTITION_DEFAULT = "1970-01-01 00:00:00"


def spark_type(name: str) -> str:
    """Spark DDL type for a warehouse type name (STRUCT/ARRAY members mapped too)."""
    text = name.strip()
    upper = text.upper()
    if "BLOB" in upper:
        return "binary"
    if upper in TYPE_MAP:
        return TYPE_MAP[upper]
    if upper.startswith(("STRUCT<", "ARRAY<")):
        def repl(m: re.Match) -> str:
            word = m.group(0)
            return TYPE_MAP.get(word.upper(), word)
        # map only type words: they follow '<', ',' or a field name + blank
        return re.sub(r"(?<=[<\s,])[A-Za-z0-9_]+(?=\s*[,>])", repl, text).lower()
    return text.lower()


def split_list(value, sep: str) -> tuple[str, ...]:
    """Config lists may be given as text with a separator or as a list; blanks dropped."""
    if value is None:
        return ()
    if isinstance(value, str):
        parts = value.split(sep)
    else:
        parts = list(value)
    return tuple(p.strip() for p in parts if str(p).strip())


@dataclass(frozen=True)
class TableSpec:
    """Per-table load settings (keys, order, merge guards, partitioning)."""

    primary_keys: tuple[str, ...]
    ordering: tuple[str, ...] = ()
    inner_where: str | None = None
    matched: str | None = None
    keep_if_null: tuple[str, ...] = ()
    never_update: tuple[str, ...] = ()
    casts: Mapping[str, str] = field(default_factory=dict)
    partition_field: str | None = None
    partition_unit: str = "DAY"
    null_partition: str = "error"  # "error" or "allow"
    partition_column: str | None = None  # physical directory key of the snapshot, if any
    dedup: str = "agg"  # "agg" (max_by per key) or "window" (row_number)
    buckets: int | None = None  # snapshot bucketed by the primary keys (catalog table)
    rewrite: str = "partitions"  # what a merge on paths rewrites: touched "partitions", or the "files" that hold a key

    def __post_init__(self):
        unit = self.partition_unit.upper()
        object.__setattr__(self, "partition_unit", unit)
        if self.partition_field and unit not in PARTITION_UNITS:
            raise ValueError(f"partition unit {unit!r} not in {PARTITION_UNITS}")
        if self.null_partition not in ("error", "allow"):
            raise ValueError("null_partition must be 'error' or 'allow'")
        if self.rewrite not in ("partitions", "files"):
            raise ValueError("rewrite must be 'partitions' or 'files'")

    @classmethod
    def from_config(cls, table_keys: Mapping, common: Mapping | None = None,
                    casts: Mapping[str, str] | None = None, query_type: str = "ARRAY_AGG") -> "TableSpec":
        """Build from the reference's key config: comma keys, semicolon order columns.
        ``query_type`` ``ROW_NUM`` selects the window dedup; any other name, the
        aggregate form (the reference's default and fallback)."""
        common = common or {}
        data = table_keys.get("DATA") or {}
        flag = table_keys.get("ERROR_IF_PARTITION_COLUMN_HAS_NULL") or \
            common.get("ERROR_IF_PARTITION_COLUMN_HAS_NULL") or "True"
        return cls(
            primary_keys=split_list(table_keys.get("PRIMARY_KEYS"), ","),
            ordering=split_list(table_keys.get("ORDERING_COLUMNS"), ";"),
            inner_where=(table_keys.get("INNER_WHERE_CLAUSE") or None),
            matched=(table_keys.get("MATCHED_CLAUSE") or None),
            keep_if_null=split_list(table_keys.get("DO_NOT_UPDATE_IF_NULL_COLUMNS"), ","),
            never_update=split_list(common.get("DO_NOT_UPDATE_COLUMNS"), ","),
            casts=dict(casts or {}),
            partition_field=(data.get("PARTITION_FIELD") or None),
            partition_unit=(data.get("PARTITION_TYPE") or "DAY"),
            null_partition="allow" if str(flag) == "False" else "error",
            dedup="window" if str(query_type).upper() == "ROW_NUM" else "agg",
        )


@dataclass(frozen=True)
class LoadSpec:
    """Settings shared by all tables of a load (common config)."""

    audit_column: str = "last_ingestion_utc_time"
    zone: str = DEFAULT_ZONE
    raw_partition_column: str | None = None  # raw table's directory key derived from the audit column
    raw_partition_unit: str = "DAY"

"""File scans (S1-S5): delimited text, newline JSON, parquet, object-store URIs and
hive-partitioned directories with typed keys.

Delimited and JSON files are read with every schema column as STRING; typing is
a separate ``safe_cast_all`` step, as in the reference's external-table load.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.project import clean_name, schema_fields
from ..spec import spark_type


def string_schema(schema_json, keys: Mapping[str, str] | None = None) -> T.StructType:
    """Every schema column as STRING (names cleaned), then the typed directory keys."""
    fields = [T.StructField(clean_name(n), T.StringType(), True) for n, _ in schema_fields(schema_json)]
    for k, t in (keys or {}).items():
        fields.append(T.StructField(k, T._parse_datatype_string(spark_type(t)), True))
    return T.StructType(fields)


def _csv_options(delimiter: str) -> dict:
    # quoting off, no multi-line records, jagged rows are errors
    return {"sep": delimiter, "quote": "", "escape": "\u0000", "multiLine": "false", "mode": "FAILFAST"}


def scan_delimited(spark: SparkSession, path: str | Sequence[str], schema_json, delimiter: str = ",",
                   header_rows: int = 0, keys: Mapping[str, str] | None = None,
                   base_path: str | None = None) -> DataFrame:
    """S1 (+S5): delimited files, every column STRING, ``header_rows`` leading lines of
    each file skipped, optional typed hive directory keys.

    Blank lines are skipped, whatever the header. One header row uses the CSV reader's own
    ``header`` option. More rows are cut in one scan without a shuffle: the leading lines of
    a file sit in its first split, whose lines reach the task in file order, so each line
    gets its number there; only a hash of the file's name goes through Python for that.
    """
    schema = string_schema(schema_json, keys)
    opts = _csv_options(delimiter)
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    if header_rows <= 1:
        return reader.schema(schema).options(**opts).option("header", str(header_rows == 1).lower()).csv(path)
    key_fields = [f for f in schema.fields if f.name in (keys or {})]
    text_schema = T.StructType([T.StructField("value", T.StringType())] + key_fields)
    lines = reader.schema(text_schema).text(path).select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"))
    body = drop_leading_lines(lines, header_rows).drop("__file")
    return parse_delimited(body, schema_json, delimiter, [f.name for f in key_fields])


def drop_leading_lines(lines: DataFrame, n: int) -> DataFrame:
    """Drop the first ``n`` lines of every file, and blank lines, from a text frame that
    carries ``__file`` (file path) and ``__block`` (split start); one pass, no shuffle."""
    if n > 0:
        # order-dependent, so the optimizer must not move it past other steps
        number = _line_number.asNondeterministic()(F.when(F.col("__block") == 0, F.pmod(F.xxhash64("__file"), F.lit(1 << 52))))
        lines = lines.withColumn("__line", number).where(F.col("__line").isNull() | (F.col("__line") >= n)).drop("__line")
    return lines.where(F.trim("value") != "").drop("__block")


def parse_delimited(lines: DataFrame, schema_json, delimiter: str, keep: Sequence[str] = ()) -> DataFrame:
    """Split a ``value`` text column into the schema's STRING columns (quoting off,
    jagged rows are errors); ``keep`` columns pass through after them."""
    data_schema = string_schema(schema_json)
    parsed = lines.select(F.from_csv("value", data_schema.simpleString(), _csv_options(delimiter)).alias("__r"),
                          *[F.col(c) for c in keep])
    return parsed.select("__r.*", *keep)


@F.pandas_udf(T.LongType())
def _line_number(files: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """0-based number of each line within its file; NULL where the file is NULL."""
    seen: dict[int, int] = {}
    for f in files:
        numbers = f.groupby(f, sort=False).cumcount() + f.map(seen).fillna(0)
        for file, n in f.value_counts().items():
            seen[file] = seen.get(file, 0) + int(n)
        yield numbers.where(f.notna()).astype("Int64")


def scan_ndjson(spark: SparkSession, path: str | Sequence[str], schema_json,
                keys: Mapping[str, str] | None = None, base_path: str | None = None) -> DataFrame:
    """Newline-delimited JSON with the declared columns as STRING (plus typed keys)."""
    reader = spark.read.schema(string_schema(schema_json, keys))
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.json(path)


def scan_parquet(spark: SparkSession, path: str | Sequence[str], base_path: str | None = None,
                 merge_schema: bool = False) -> DataFrame:
    """S3: parquet with hive partition keys discovered under ``base_path``."""
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(*([path] if isinstance(path, str) else path))


def scan_object_store(spark: SparkSession, uri: str, hadoop_conf: Mapping[str, str] | None = None) -> DataFrame:
    """Parquet from an object-store URI (``s3a://``, ``gs://``, ``file://``).
    Store settings (endpoint, signing version, credentials provider) are options of this read alone. Hadoop keeps one
    open store per scheme and host whatever its settings, so a read with settings opens its own: two reads
    in one session do not mix. Credentials come from the cluster, never from code."""
    options = dict(hadoop_conf or {})
    if options:
        options.setdefault(f"fs.{uri.partition('://')[0]}.impl.disable.cache", "true")
    return spark.read.options(**options).parquet(uri)


def scan_partitioned(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str,
                     keys: Mapping[str, str], options: Mapping[str, str] | None = None) -> DataFrame:
    """Hive directories whose keys get the declared types (CUSTOM mode): the key
    columns are appended to the read schema, so discovery parses them as typed."""
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    fields = list(st.fields) + [T.StructField(k, T._parse_datatype_string(spark_type(t)), True)
                                for k, t in keys.items()]
    return spark.read.format(fmt).options(**(options or {})).schema(T.StructType(fields)).load(path)

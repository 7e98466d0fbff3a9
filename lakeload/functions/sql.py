"""The scalar functions as SQL functions, for jobs written as SQL text.

``register_sql_functions(spark)`` defines them as temporary SQL-language
functions (``CREATE TEMPORARY FUNCTION ... RETURN <expr>``). Spark inlines their
bodies into the plan, so they run in the JVM like built-ins, with no Python.
Each body is the SQL form of the same-named Column function in ``scalars``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
_INSTANT = "to_timestamp(concat(run_id, ' ', zone), 'yyyyMMddHHmmss VV')"

FUNCTIONS = {
    "epoch_ms_to_run_id": (
        "ms BIGINT, zone STRING", "STRING",
        f"date_format(convert_timezone('UTC', zone, timestampadd(MILLISECOND, ms, {_EPOCH})), 'yyyyMMddHHmmss')"),
    "run_id_to_epoch_ms": (
        "run_id STRING, zone STRING", "STRING",
        f"CAST(unix_millis({_INSTANT}) - CASE WHEN date_format(convert_timezone('UTC', zone, "
        f"timestampadd(MICROSECOND, unix_micros({_INSTANT}), {_EPOCH})), 'yyyyMMddHHmmss') <> run_id "
        f"THEN 3600000 ELSE 0 END AS STRING)"),
    "run_sequence": (
        "ts TIMESTAMP_NTZ, freq INT", "INT",
        "CASE WHEN (floor(timestampdiff(SECOND, CAST(date_trunc('DAY', ts) AS TIMESTAMP_NTZ), ts) / (freq * 60)) + 1)"
        " * freq <= 1440 THEN CAST(floor(timestampdiff(SECOND, CAST(date_trunc('DAY', ts) AS TIMESTAMP_NTZ), ts)"
        " / (freq * 60)) + 1 AS INT) END"),
    "elapsed_sequences": (
        "start_ts TIMESTAMP_NTZ, end_ts TIMESTAMP_NTZ, step INT", "DOUBLE",
        "CAST(timestampdiff(MICROSECOND, start_ts, end_ts) AS DOUBLE) / (step * 60000000.0)"),
    "json_attr": (
        "doc STRING, path STRING, dflt STRING", "STRING",
        "coalesce(get_json_object(doc, path), dflt)"),
    "short_name": (
        "t STRING, n INT", "STRING",
        "lower(array_join(transform(split(t, '_', -1), w -> substring(w, 1, n)), ''))"),
    "text_checksum": (
        "t STRING", "BIGINT",
        "crc32(CAST(t AS BINARY))"),
    "truncate_text": (
        "t STRING, n INT", "STRING",
        "CASE WHEN octet_length(t) <= n THEN t ELSE substring(t, 1, n) END"),
    "partition_key": (
        "ts TIMESTAMP_NTZ, unit STRING", "TIMESTAMP_NTZ",
        "CASE WHEN upper(unit) = 'HOUR' THEN make_timestamp_ntz(year(ts), month(ts), day(ts), hour(ts), 0, 0) "
        "WHEN upper(unit) = 'DAY' THEN CAST(to_date(ts) AS TIMESTAMP_NTZ) "
        "ELSE CAST(trunc(to_date(ts), unit) AS TIMESTAMP_NTZ) END"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions; returns their names."""
    for name, (params, returns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return list(FUNCTIONS)

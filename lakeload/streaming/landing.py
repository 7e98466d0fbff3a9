"""Incremental file landing with Structured Streaming.

The reference lands whatever files arrived since the last scheduled run. Here
the file source keeps that bookkeeping in its checkpoint: each run (an
``availableNow`` trigger, or a processing-time trigger for a long-running job)
picks up only new files, and each micro-batch goes through the same steps as a
batch load - leading header lines dropped, delimited parse, ``try_cast`` to the
schema types, audit columns - and is appended to the raw table.

Replays are idempotent: every micro-batch overwrites its own ``load_batch``
partition (dynamic partition overwrite), so a batch re-run after a failure
replaces its earlier partial output instead of duplicating it. The partition names
the stream by the id in its checkpoint and the batch by its number, so streams with
checkpoints of their own never overwrite each other's batches.
"""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import partition_value
from ..operators.project import add_audit_columns, safe_cast_all, schema_fields
from ..sources.files import drop_leading_lines, parse_delimited
from ..spec import DEFAULT_ZONE, spark_type

BATCH_COLUMN = "load_batch"
INGESTION_COLUMN = "last_ingestion_utc_time"


def land_batch(batch: DataFrame, batch_key: str, raw_path: str, schema_json, delimiter: str,
               header_rows: int, audit_exprs: Sequence[str], source_timezone: str,
               partition_field: str | None, partition_unit: str | None) -> None:
    """One micro-batch of text lines (with file metadata) -> typed raw rows."""
    body = drop_leading_lines(batch, header_rows)
    parsed = parse_delimited(body, schema_json, delimiter, keep=[INGESTION_COLUMN])
    typed = safe_cast_all(parsed, schema_json)
    cols = [n.replace(" ", "_") for n, _ in schema_fields(schema_json)]
    out = add_audit_columns(typed, audit_exprs, source_timezone, schema_cols=cols).withColumn(
        BATCH_COLUMN, F.lit(batch_key))
    parts = [BATCH_COLUMN]
    if partition_field and partition_unit:
        out = out.withColumn(f"{partition_field}_part", partition_value(F.col(partition_field), partition_unit))
        parts.append(f"{partition_field}_part")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts).parquet(raw_path))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a started query's checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def land_files_stream(spark: SparkSession, source_dir: str, raw_path: str, checkpoint: str, schema_json,
                      delimiter: str = "|", header_rows: int = 0, audit_exprs: Sequence[str] = (),
                      source_timezone: str = DEFAULT_ZONE, partition_field: str | None = None,
                      partition_unit: str | None = None, max_files_per_trigger: int | None = None,
                      available_now: bool = True, processing_time: str | None = None,
                      folder_key: str | None = None, folder_key_type: str = "TIMESTAMP") -> StreamingQuery:
    """Start the landing stream. ``last_ingestion_utc_time`` comes from the hive
    folder key ``folder_key`` when given (typed by ``folder_key_type``), else it is
    the landed file's modification time; both are properties of the file, so a
    replayed batch gets the same values."""
    schema = "value string" + (f", `{folder_key}` {spark_type(folder_key_type)}" if folder_key else "")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    ingestion = F.col(folder_key) if folder_key else F.col("_metadata.file_modification_time")
    lines = reader.text(source_dir).select(
        "value", F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        ingestion.cast("timestamp_ntz").alias(INGESTION_COLUMN))

    def run(batch: DataFrame, epoch_id: int) -> None:
        land_batch(batch, f"{stream_id(spark, checkpoint)}-{epoch_id}", raw_path, schema_json, delimiter, header_rows, audit_exprs,
                   source_timezone, partition_field, partition_unit)

    writer = lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()

"""Flattening of nested job statistics into rows.

Input: one row per job with the statistics as a nested column

    job_id, parent_job_id (NULL for a top-level job), query,
    statistics struct<startTime, endTime, query struct<numDmlAffectedRows,
        queryPlan array<struct<name, startMs, endMs, recordsRead, inputStages array<string>,
                                steps array<struct<kind, substeps array<string>>>>>>>,
    destination struct<datasetId, tableId> (NULL when there is no target),
    params struct<end_time_ms (run id), seq_num, job_name>

Output rows share one schema: a ``JOB`` row per job and a ``STAGE`` row per plan
stage (``explode`` of the plan; a job with no plan has none). Everything is
column expressions on the nested data; no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import checksum, run_id_to_epoch_ms, truncate

# The reference's stats constants.
NO_TARGET = "NO_TARGET_SPECIFIED"
QUERY_LIMIT = 4000
INPUT_MARK = "Input"
READ_KIND = "READ"
INPUT_JOIN = "__::__"
OTHER_JOIN = "__::__ "
INPUT_PREFIX = "Input stage : "

STAT_COLUMNS = ["end_time_ms", "seq_num", "job_id", "job_name", "query_type", "checksum", "query",
                "db_name", "init_time", "end_time", "record_count", "time_taken"]


def full_job_id(df: DataFrame) -> Column:
    """A child job's id is ``parent:child``."""
    return F.when(F.col("parent_job_id").isNotNull(),
                  F.concat_ws(":", F.col("parent_job_id"), F.col("job_id"))).otherwise(F.col("job_id")) \
        if "parent_job_id" in df.columns else F.col("job_id")


def _job_row(df: DataFrame) -> Column:
    s = F.col("statistics")
    dest = F.col("destination")
    db = F.when(dest.isNotNull(), F.concat_ws(":", dest["datasetId"], dest["tableId"])).otherwise(F.lit(NO_TARGET))
    return F.struct(
        run_id_to_epoch_ms(F.col("params.end_time_ms")).alias("end_time_ms"),
        F.col("params.seq_num").alias("seq_num"), full_job_id(df).alias("job_id"),
        F.col("params.job_name").alias("job_name"), F.lit("JOB").alias("query_type"),
        checksum(F.col("query")).alias("checksum"), truncate(F.col("query"), QUERY_LIMIT).alias("query"),
        db.alias("db_name"), s["startTime"].alias("init_time"), s["endTime"].alias("end_time"),
        F.coalesce(s["query"]["numDmlAffectedRows"], F.lit("0")).cast("string").alias("record_count"),
        ((s["endTime"] - s["startTime"]) / 1000.0).alias("time_taken"))


def job_stats(df: DataFrame) -> DataFrame:
    """One ``JOB`` row per job: seconds = (end - start) / 1000, affected rows
    default ``"0"``, target ``dataset:table`` or ``NO_TARGET_SPECIFIED``, CRC-32 of
    the full query text, text cut to 4000 characters."""
    return df.select(_job_row(df).alias("__r")).select("__r.*")


def stage_text(stage: Column) -> Column:
    """For ``Input`` stages the READ steps' substeps joined ``', '``, steps joined
    ``__::__``; otherwise ``kind:substeps`` per step joined ``__::__ ``."""
    is_input = stage["name"].contains(INPUT_MARK)
    steps = stage["steps"]
    reads = F.filter(steps, lambda st: st["kind"] == F.lit(READ_KIND))
    input_text = F.array_join(F.transform(reads, lambda st: F.array_join(st["substeps"], ", ")), INPUT_JOIN)
    other_text = F.array_join(
        F.transform(steps, lambda st: F.concat(st["kind"], F.lit(":"), F.array_join(st["substeps"], ", "))),
        OTHER_JOIN)
    return F.when(is_input, input_text).otherwise(other_text)


def stage_source(name: Column, text: Column, input_stages: Column) -> Column:
    """For an ``Input`` stage whose lower-cased, whitespace-split text holds
    ``from``: the token after the first ``from`` (``""`` when it is last); for any
    other stage ``Input stage : `` + the input stage names comma-joined."""
    tokens = F.split(F.trim(F.lower(text)), r"\s+")
    pos = F.array_position(tokens, "from")
    after = F.coalesce(F.try_element_at(tokens, (pos + 1).cast("int")), F.lit(""))
    return F.when(name.contains(INPUT_MARK) & (pos > 0), after) \
        .otherwise(F.concat(F.lit(INPUT_PREFIX), F.array_join(F.coalesce(input_stages, F.array()), ",")))


def stage_stats(df: DataFrame) -> DataFrame:
    """One ``STAGE`` row per plan stage (jobs without a plan give none). The
    per-job values are computed once per job, next to the exploded stage."""
    staged = df.select(
        run_id_to_epoch_ms(F.col("params.end_time_ms")).alias("__end_ms"), F.col("params.seq_num").alias("__seq"),
        full_job_id(df).alias("__job_id"), F.col("params.job_name").alias("__job_name"),
        F.explode(F.col("statistics.query.queryPlan")).alias("__st"))
    st = F.col("__st")
    text = stage_text(st)
    return staged.select(
        F.col("__end_ms").alias("end_time_ms"), F.col("__seq").alias("seq_num"), F.col("__job_id").alias("job_id"),
        F.col("__job_name").alias("job_name"), F.lit("STAGE").alias("query_type"),
        checksum(text).alias("checksum"), text.alias("query"),
        stage_source(st["name"], text, st["inputStages"]).alias("db_name"),
        st["startMs"].alias("init_time"), st["endMs"].alias("end_time"),
        st["recordsRead"].cast("string").alias("record_count"),
        ((st["endMs"].cast("bigint") - st["startMs"].cast("bigint")) / 1000.0).alias("time_taken"))


def all_stats(jobs: DataFrame) -> DataFrame:
    """Job rows and stage rows of parent and child jobs. The two branches read
    mostly disjoint columns (query text vs. plan), so the union costs little extra
    I/O; packing the long query text into one exploded array measured slower."""
    return job_stats(jobs).unionByName(stage_stats(jobs))

"""Run-window planning (W1-W8) as frames over *all* jobs at once.

The reference plans windows for one job at a time on the scheduler host; here a
request is a row, the grid of run ids is ``explode(sequence(1, n))`` per row
(bounded by minutes-per-week / refresh), and the per-job decisions are window
functions partitioned by job. Errors become status values, not exceptions, so
one bad job never stops the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import elapsed_sequences, json_attr
from ..spec import RUN_ID_FORMAT
from .project import q

# The reference's default run-id format (strftime form) and the
# scheduler's zone for run attributes.
DEFAULT_RUN_ID_FORMAT = "%Y%m%d%H%M%S"
SCHEDULER_ZONE = "America/Los_Angeles"
CATCH_UP_AFTER_HOURS = 2
SPLIT_BELOW_MINUTES = 30


def strftime_format(ts: Column, fmt: Column) -> Column:
    """``strftime`` for the directives run-id formats use (%Y %m %d %H %M %S);
    any other text (e.g. a fixed ``075959``) is kept literally."""
    out = fmt
    for directive, pattern in (("%Y", "yyyy"), ("%m", "MM"), ("%d", "dd"), ("%H", "HH"), ("%M", "mm"),
                               ("%S", "ss")):
        out = F.replace(out, F.lit(directive), F.date_format(ts, pattern))
    # the default format is one date_format call instead of six
    return F.when(fmt == F.lit(DEFAULT_RUN_ID_FORMAT), F.date_format(ts, RUN_ID_FORMAT)).otherwise(out)


custom_run_id = strftime_format


def window_grid(requests: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Every run id of each request. With ``keep_empty`` a request whose grid is empty
    (its refresh is longer than its slot) keeps one row, with NULL seq and run id.

    Request columns: ``job_key, seq_max, seq_num, refresh, run_date (yyyyMMdd)``,
    optional ``schedule`` (``WEEKLY`` counts 7 days) and ``run_id_format``.
    n = floor(((24*days*60)/seq_max)/refresh); start = run date + (1440/seq_max)(seq-1)
    minutes (one day, also for weekly grids); id_i = start + refresh*i minutes - 1 s.
    Adds ``seq``, ``run_ts`` (timestamp_ntz) and ``run_id``.
    """
    cols = requests.columns
    days = F.when(F.upper(q("schedule")) == "WEEKLY", F.lit(7)).otherwise(F.lit(1)) \
        if "schedule" in cols else F.lit(1)
    fmt = F.coalesce(q("run_id_format"), F.lit(DEFAULT_RUN_ID_FORMAT)) if "run_id_format" in cols \
        else F.lit(DEFAULT_RUN_ID_FORMAT)
    n = F.floor(((F.lit(24.0) * days * 60) / q("seq_max")) / q("refresh")).cast("int")
    start_us = F.round((F.lit(1440.0) / q("seq_max")) * (q("seq_num") - 1) * F.lit(60e6)).cast("bigint")
    day = F.to_timestamp_ntz(q("run_date"), F.lit("yyyyMMdd"))
    explode = F.explode_outer if keep_empty else F.explode
    grid = requests.withColumn(
        "seq", explode(F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))))
    offset = start_us + F.col("seq").cast("bigint") * q("refresh").cast("bigint") * 60_000_000 - 1_000_000
    grid = grid.withColumn("run_ts", F.timestamp_add("MICROSECOND", offset, day))
    return grid.withColumn("run_id", strftime_format(F.col("run_ts"), fmt))


def current_window(grid: DataFrame, now_run_id: str) -> DataFrame:
    """For ``seq_max = 1`` keep only the current run id - the last id before the
    first one later than ``now`` (ids in grid order), else the first id. Other
    requests keep their whole grid."""
    w = Window.partitionBy("job_key")
    now = F.lit(now_run_id)
    g = grid.withColumn("__first_gt", F.min(F.when(q("run_id") > now, q("seq"))).over(w))
    g = g.withColumn("__pick", F.coalesce(
        F.max(F.when(q("seq") < F.coalesce(F.col("__first_gt"), F.lit(1 << 30)), q("seq"))).over(w), F.lit(1)))
    keep = (q("seq_max") != 1) | (q("seq") == F.col("__pick")) | q("seq").isNull()
    return g.where(keep).drop("__first_gt", "__pick")


def pending_windows(grid: DataFrame, last_run: DataFrame) -> DataFrame:
    """Run ids still to process per job, or one status row when none are; every job of
    the grid has at least one row. Build the grid with ``keep_empty``: a job without any
    run id then gets ``ERROR_EMPTY_GRID``.

    ``last_run``: ``job_key, status, last_run_id`` (at most one row per job). Rules:
    no last run -> all ids; FAILED -> from the failed id inclusive, rerun ``Y``;
    COMPLETED -> the ids after it (none when it was the last: ``DONE``); another
    status, an id not in the grid, or a missing status/id -> an ``ERROR_*`` status.
    When the first pending id is later than ``min_run_id_to_process`` (grid column,
    optional) nothing is pending (``SKIPPED``).
    """
    lr = last_run.select(q("job_key"), q("status").alias("__st"), q("last_run_id").alias("__lid"),
                         F.lit(True).alias("__present"))
    g = grid.join(lr, "job_key", "left")
    w = Window.partitionBy("job_key")
    present = F.coalesce(F.col("__present"), F.lit(False))
    complete = present & F.col("__st").isNotNull() & F.col("__lid").isNotNull()
    idx = F.min(F.when(q("run_id") == F.col("__lid"), q("seq"))).over(w)
    n = F.max(q("seq")).over(w)
    g = g.withColumn("__idx", idx).withColumn("__n", n)
    st, i, seq = F.col("__st"), F.col("__idx"), q("seq")
    status = (F.when(seq.isNull(), F.lit("ERROR_EMPTY_GRID"))
              .when(~present, F.lit("PENDING"))
              .when(~complete, F.lit("ERROR_MISSING_STATUS_OR_RUN_ID"))
              .when(i.isNull(), F.lit("ERROR_UNKNOWN_LAST_RUN_ID"))
              .when(st == "FAILED", F.when(seq >= i, F.lit("PENDING")).otherwise(F.lit("DONE")))
              .when(st == "COMPLETED", F.when(seq > i, F.lit("PENDING")).otherwise(F.lit("DONE")))
              .otherwise(F.lit("ERROR_UNKNOWN_STATUS")))
    g = g.withColumn("__status", status)
    pend = F.col("__status") == "PENDING"
    g = g.withColumn("__first", F.min_by(F.when(pend, q("run_id")), F.when(pend, seq)).over(w))
    if "min_run_id_to_process" in grid.columns:
        skipped = F.coalesce(F.col("__first") > q("min_run_id_to_process"), F.lit(False))
    else:
        skipped = F.lit(False)
    g = g.withColumn("__skip", skipped)
    g = g.withColumn("__any_pending", F.max(pend.cast("int")).over(w) == 1)
    rerun = F.when(complete & (st == "FAILED"), F.lit("Y")).otherwise(F.lit("N"))
    job_status = (F.when(F.col("__skip"), F.lit("SKIPPED"))
                  .when(F.col("__any_pending"), F.lit(None))
                  .otherwise(F.max(F.when(F.col("__status") != "PENDING", F.col("__status"))).over(w)))
    g = g.withColumn("__job_status", job_status)
    # a row is either a pending run id or the one status row of a job without any
    # (never both), so one filter replaces a union of two passes over the grid. The
    # status sits on the first row that the job still has: its grid may be cut to one
    # later run id, or be empty
    pending_row = pend & ~F.col("__skip")
    first_row = q("seq").isNull() | (q("seq") == F.min(q("seq")).over(w))
    g = g.withColumn("__first_row", first_row)
    status_row = F.col("__first_row") & F.col("__job_status").isNotNull()
    return g.where(pending_row | status_row).select(
        "job_key", F.when(pending_row, q("seq")).alias("seq"), F.when(pending_row, q("run_id")).alias("run_id"),
        rerun.alias("rerun_indicator"),
        F.when(pending_row, F.lit("PENDING")).otherwise(F.col("__job_status")).alias("status"))


def split_windows(runs: DataFrame, dag_frequency: int, catch_up_col: str | None = None) -> DataFrame:
    """A schedule window of a job running more often than every 30 minutes is
    split into sub-windows of the job's frequency; the schedule frequency must be
    a multiple of it (else ``ERROR_FREQUENCY``). Sequence = int(elapsed sequences
    since midnight + k + 1). A catch-up run (``catch_up_col`` true) stays one window.

    ``runs``: ``job_key, job_frequency, run_date (yyyyMMdd), run_datetime
    (yyyyMMddHHmmss), seq_num``. Output adds ``sub_run_datetime, sub_seq, status``.
    """
    f = q("job_frequency")
    run_ts = F.to_timestamp_ntz(q("run_datetime"), F.lit(RUN_ID_FORMAT))
    day = F.to_timestamp_ntz(q("run_date"), F.lit("yyyyMMdd"))
    small = f < SPLIT_BELOW_MINUTES
    catch = F.coalesce(q(catch_up_col), F.lit(False)) if catch_up_col else F.lit(False)
    # the multiple-of check comes first, as in the reference: it fails catch-up runs too
    bad = small & (F.lit(dag_frequency) % f != 0)
    count = (F.lit(dag_frequency) / f).cast("int")
    parts = F.when(small & ~catch & ~bad, F.sequence(F.lit(0), count - 1)).otherwise(F.array(F.lit(0)))
    out = runs.withColumn("__k", F.explode(parts))
    split = small & ~catch & ~bad
    sub_ts = F.timestamp_add("MINUTE", F.col("__k") * f, run_ts)
    seq = (elapsed_sequences(day, run_ts, 1).cast("double") / f + F.col("__k") + 1).cast("int")
    return out.select(
        *runs.columns,
        F.when(split, F.date_format(sub_ts, RUN_ID_FORMAT)).otherwise(q("run_datetime")).alias("sub_run_datetime"),
        F.when(split, seq).when(bad, F.lit(None).cast("int")).otherwise(q("seq_num")).alias("sub_seq"),
        F.when(bad, F.lit("ERROR_FREQUENCY")).when(split, F.lit("SPLIT"))
         .when(catch & small, F.lit("CATCH_UP")).otherwise(F.lit("SINGLE")).alias("status"))


def local_epoch_seconds(wall_clock: Column, zone: str = SCHEDULER_ZONE) -> Column:
    """Epoch seconds of a wall-clock timestamp_ntz read in ``zone``."""
    text = F.concat(F.date_format(wall_clock, RUN_ID_FORMAT), F.lit(" " + zone))
    return F.unix_seconds(F.to_timestamp(text, RUN_ID_FORMAT + " VV"))


def catch_up(df: DataFrame, runs: DataFrame, now_run_id: str) -> DataFrame:
    """Adds ``catch_up``: job frequency under 30 min, ``now`` later than the run
    time + 2 h, the ``catch_up`` attribute true (default), and no COMMITTED run at
    the window's end time (ms, scheduler zone).

    ``df``: ``job_key, job_frequency, run_datetime, job_attributes``;
    ``runs``: ``job_key, job_runtime_ms, job_status_code``.
    """
    run_ts = F.to_timestamp_ntz(q("run_datetime"), F.lit(RUN_ID_FORMAT))
    late = F.to_timestamp_ntz(F.lit(now_run_id), F.lit(RUN_ID_FORMAT)) > \
        F.timestamp_add("HOUR", F.lit(CATCH_UP_AFTER_HOURS), run_ts)
    enabled = F.lower(json_attr(q("job_attributes"), "catch_up", "true")) == "true"
    end_ms = local_epoch_seconds(F.timestamp_add("MINUTE", q("job_frequency"), run_ts)) * 1000
    committed = (runs.where(q("job_status_code") == "COMMITTED")
                 .select(q("job_key").alias("__jk"), q("job_runtime_ms").alias("__ms")).distinct()
                 .withColumn("__done", F.lit(True)))
    j = df.withColumn("__end_ms", end_ms).join(
        committed, (q("job_key") == F.col("__jk")) & (F.col("__end_ms") == F.col("__ms")), "left")
    flag = (q("job_frequency") < SPLIT_BELOW_MINUTES) & late & enabled & F.col("__done").isNull()
    return j.select(*df.columns, F.coalesce(flag, F.lit(False)).alias("catch_up"))


def validate_requests(df: DataFrame, today: str) -> DataFrame:
    """``status`` and ``catchup`` per request: seq above max, a run date that is
    not ``yyyyMMdd`` or lies in the future are errors; a past date is a catch-up."""
    rd = q("run_date")
    parsed = F.try_to_timestamp(rd, F.lit("yyyyMMdd"))
    valid = rd.rlike(r"^\d{8}$") & parsed.isNotNull()
    status = (F.when(q("seq_num") > q("seq_max"), F.lit("ERROR_SEQ_NUM"))
              .when(~valid, F.lit("ERROR_RUN_DATE"))
              .when(rd > F.lit(today), F.lit("ERROR_FUTURE_RUN_DATE"))
              .otherwise(F.lit("OK")))
    return df.select("*", status.alias("status"),
                     F.when(status == "OK", rd < F.lit(today)).alias("catchup"))


def run_attributes(df: DataFrame) -> DataFrame:
    """Run attributes of a job execution. With ``runtime_in_ms_enabled`` (logic
    attribute, default true) the runtime is the window end (run time + frequency)
    in the scheduler zone, in ms, and a related job becomes the parent; otherwise
    the run time in seconds.

    ``df``: ``job_key, job_name, run_datetime, job_frequency, seq, related_job_key,
    application_system_key, data_entity_key, logic_attributes``.
    """
    run_ts = F.to_timestamp_ntz(q("run_datetime"), F.lit(RUN_ID_FORMAT))
    ms_on = F.lower(json_attr(q("logic_attributes"), "runtime_in_ms_enabled", "true")) == "true"
    runtime = F.when(ms_on, local_epoch_seconds(F.timestamp_add("MINUTE", q("job_frequency"), run_ts)) * 1000) \
        .otherwise(local_epoch_seconds(run_ts))
    return df.select(
        q("job_key").alias("job_key"), q("job_name").alias("job_name"), runtime.alias("job_runtime_ms"),
        q("seq").alias("job_run_sequence"), q("job_frequency").alias("job_frequency_code"),
        q("application_system_key").alias("system_key"), q("data_entity_key").alias("data_entity_key"),
        F.when(ms_on & q("related_job_key").isNotNull(), q("related_job_key")).alias("parent_job_key"))

"""Scalar column functions (F1-F9). All are built-in Spark expressions, so they
stay inside whole-stage codegen and never depend on the session time zone."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import DEFAULT_ZONE, RUN_ID_FORMAT


def ntz_lit(value) -> Column:
    """A timestamp_ntz literal that does not depend on the session zone. (A Python
    datetime given to ``lit`` becomes a zoned timestamp; its text does not.)"""
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat() + " 00:00:00"
    return F.lit(value).cast("timestamp_ntz")


def _epoch_ntz() -> Column:
    return ntz_lit("1970-01-01 00:00:00")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def run_id_to_instant(run_id, zone: str = DEFAULT_ZONE) -> Column:
    """Run id text (``yyyyMMddHHmmss`` wall clock in ``zone``) -> timestamp instant."""
    text = F.lit(run_id) if isinstance(run_id, str) and run_id.isdigit() else _c(run_id)
    return F.to_timestamp(F.concat(text, F.lit(" " + zone)), RUN_ID_FORMAT + " VV")


def run_id_to_utc_ntz(run_id, zone: str = DEFAULT_ZONE) -> Column:
    """Run id wall clock in ``zone`` -> UTC wall clock as timestamp_ntz."""
    text = F.lit(run_id) if isinstance(run_id, str) and run_id.isdigit() else _c(run_id)
    return F.convert_timezone(F.lit(zone), F.lit("UTC"),
                              F.to_timestamp_ntz(text, F.lit(RUN_ID_FORMAT)))


def epoch_ms_to_ntz(col) -> Column:
    """Epoch milliseconds -> UTC wall clock (timestamp_ntz), by arithmetic only."""
    return F.timestamp_add("MILLISECOND", _c(col).cast("bigint"), _epoch_ntz())


def epoch_ms_to_run_id(col, zone: str = "UTC") -> Column:
    """epoch ms -> ``yyyyMMddHHmmss`` in ``zone``; the fraction is dropped."""
    ntz = epoch_ms_to_ntz(col)
    if zone.upper() != "UTC":
        ntz = F.convert_timezone(F.lit("UTC"), F.lit(zone), ntz)
    return F.date_format(ntz, RUN_ID_FORMAT)


def _utc_wall_clock(instant: Column) -> Column:
    """An instant as its UTC wall clock (timestamp_ntz), without the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch_ntz())


def ntz_to_instant(wall: Column) -> Column:
    """A UTC wall clock (timestamp_ntz) as an instant. Goes through the text, as Spark's
    differences and formats of timestamp_ntz read it in the session zone first."""
    return F.concat(wall.cast("string"), F.lit("Z")).cast("timestamp")


def run_id_to_epoch_ms(col, zone: str = DEFAULT_ZONE, gap: str = "daylight") -> Column:
    """run id read in ``zone`` -> epoch milliseconds as text.

    The repeated autumn hour resolves to the earlier (daylight) offset. For a wall
    time inside the spring-forward gap, ``gap="daylight"`` reads it with the daylight
    offset, as the reference does (``20240310023000`` -> 09:30 UTC); ``"forward"``
    keeps Java's rule of moving it forward by the gap (10:30 UTC). The gap is found
    by a round trip: the instant's wall clock in ``zone`` differs from the input.
    """
    text = _c(col)
    instant = run_id_to_instant(text, zone)
    ms = F.unix_millis(instant)
    if gap == "daylight":
        local = F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), _utc_wall_clock(instant)),
                              RUN_ID_FORMAT)
        ms = F.when(local != text, ms - F.lit(3_600_000)).otherwise(ms)
    return ms.cast("string")


def run_sequence(ts, freq_min: int) -> Column:
    """1-based index within the day of ``ts`` on a ``freq_min`` grid.

    ``ts`` is the local execution time (interval start + frequency). NULL when the
    index passes the end of the day grid (frequencies that do not divide 1440).
    """
    t = _c(ts).cast("timestamp_ntz")
    sod = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    seq = F.floor(sod / F.lit(freq_min * 60)).cast("int") + 1
    return F.when(seq * F.lit(freq_min) <= 1440, seq)


def elapsed_sequences(start, end, step_min: int) -> Column:
    """(end - start) / step as a fractional count."""
    a, b = (F.unix_micros(ntz_to_instant(utc_ntz(x))) for x in (start, end))
    return (b - a).cast("double") / F.lit(step_min * 60e6)


def _json_path(path) -> str:
    keys = path.split(".") if isinstance(path, str) else list(path)
    out = "$"
    for k in keys:
        out += f".{k}" if k.replace("_", "").isalnum() else f"['{k}']"
    return out


def json_attr(col, path, default: str | None = None) -> Column:
    """value at a nested key path of a JSON text column, else ``default``."""
    value = F.get_json_object(_c(col), _json_path(path))
    return value if default is None else F.coalesce(value, F.lit(default))


def short_name(col, n: int) -> Column:
    """first ``n`` letters of each ``_``-separated word, joined, lower-cased."""
    words = F.split(_c(col), "_", -1)
    return F.lower(F.array_join(F.transform(words, lambda w: F.substring(w, 1, n)), ""))


def job_labels(target_table, label, dataset, end_run_id, run_no, now_run_id, prefix: str = "") -> Column:
    """the nine job tags as one struct column (current time is a parameter)."""
    t, lb, ds, end, rn = (_c(x) for x in (target_table, label, dataset, end_run_id, run_no))
    now = F.lit(now_run_id) if isinstance(now_run_id, str) else _c(now_run_id)
    p = F.lit(prefix)
    s2, s1 = short_name(t, 2), short_name(t, 1)
    end_tail = F.substring(end, 3, 1 << 20)
    first = F.substring(lb, 1, 1)
    rn_s = rn.cast("string")
    instance = F.concat_ws("-", p, first, s1, end_tail, rn_s)
    return F.struct(
        instance.alias("job_instance_id"),
        F.concat_ws("-", p, F.lower(t)).alias("table_name"),
        p.alias("property"),
        F.concat_ws("-", p, lb).alias("task"),
        F.concat_ws("-", p, ds).alias("dataset"),
        F.concat_ws("-", p, ds, s2).alias("resource_name"),
        F.concat_ws("-", p, lb, s2, end_tail).alias("billing_tag"),
        instance.alias("job_run_id"),
        F.concat_ws("-", p, now).alias("ingestion_time"),
    )


def checksum(col) -> Column:
    """F8: CRC-32 of the UTF-8 bytes of a text column (Spark strings are UTF-8, so
    the cast to binary hands over those bytes without re-encoding)."""
    return F.crc32(_c(col).cast("binary"))


def truncate(col, n: int = 4000) -> Column:
    """F8: first ``n`` characters. A text of at most ``n`` bytes has at most ``n``
    characters and is returned as is, without walking its characters."""
    c = _c(col)
    return F.when(F.octet_length(c) <= n, c).otherwise(F.substring(c, 1, n))


def utc_ntz(col) -> Column:
    """A time column as UTC wall clock (timestamp_ntz): an instant is converted, other
    flavours keep their wall clock. ``typeof`` folds, so one branch remains in the plan."""
    c = _c(col)
    return F.when(F.typeof(c) == F.lit("timestamp"), _utc_wall_clock(c.cast("timestamp"))) \
        .otherwise(c.cast("timestamp_ntz"))


def partition_key(ts, unit: str) -> Column:
    """truncate a time column to its partition unit, as UTC wall clock (timestamp_ntz).

    Instants are read in UTC first, and the truncation works on dates (and hours of a
    wall clock), so neither step sees the session zone.
    """
    wall, unit = utc_ntz(ts), unit.upper()
    if unit == "HOUR":
        return F.make_timestamp_ntz(F.year(wall), F.month(wall), F.day(wall), F.hour(wall), F.lit(0), F.lit(0))
    day = F.to_date(wall)
    return (day if unit == "DAY" else F.trunc(day, unit)).cast("timestamp_ntz")


def partition_value(col, unit: str) -> Column:
    """Directory value of a truncated partition key: DATE for DAY/MONTH/YEAR,
    ``yyyyMMddHH`` as int for HOUR (both survive partition-type inference)."""
    key = partition_key(col, unit)
    if unit.upper() == "HOUR":
        return F.date_format(key, "yyyyMMddHH").cast("int")
    return F.to_date(key)

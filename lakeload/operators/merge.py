"""Upsert of a deduplicated slice into a snapshot (M1-M8).

``MERGE INTO`` is not available on plain parquet tables, so the merge is a
declarative plan:

    in    = target rows whose truncated partition value is in the touched set
            [or whose partition value is NULL, when NULL partitions are allowed]
    rest  = all other target rows: not joined, not rewritten
    join  = in (non-NULL keys) FULL OUTER source (non-NULL keys) ON cast(s.k) = t.k
    out   = insert (no target) | update (both sides, guard true) | keep target
    rows with a NULL key never match: target ones pass through, source ones insert

The target's NULL keys are split off before the join, so that a NULL "hot key" (which
can hold a large share of rows) stays out of the join's single partition. The source
needs no such split: it holds one row per key already, and an outer join never matches
NULLs. The touched set is a frame of distinct partition values, joined to the target
whatever its size; its two bounds also go to the scan as a range filter, in which the
stand-in for NULL has no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ntz_lit, partition_key, utc_ntz
from ..session import written
from ..spec import NULL_PARTITION_DEFAULT, TableSpec, spark_type
from .project import q


def check_partition_nulls(df: DataFrame, spec: TableSpec) -> DataFrame:
    """M8: under the ``error`` policy a NULL partition value fails the job. The check
    is lazy (``raise_error`` in the projection), so it costs no extra pass."""
    p = spec.partition_field
    if not p or spec.null_partition != "error":
        return df
    msg = f"partition column {p} has NULL values in the source slice"
    checked = F.when(q(p).isNull(), F.raise_error(F.lit(msg))).otherwise(q(p))
    return df.withColumn(p, checked)


def touched_partitions_frame(source: DataFrame, spec: TableSpec) -> DataFrame:
    """M7 as a frame: distinct truncated partition values of the un-deduplicated slice.
    With NULL partitions allowed, NULL becomes 1970-01-01."""
    p = q(spec.partition_field)
    if spec.null_partition == "allow":
        p = F.coalesce(utc_ntz(p), ntz_lit(NULL_PARTITION_DEFAULT))
    return check_partition_nulls(source, spec).select(
        partition_key(p, spec.partition_unit).alias("partition_key")).distinct()


@dataclass(frozen=True)
class Bounds:
    """What the scan of the target needs to know of the touched partitions: the smallest and largest key that stands for
    itself (None if there is none), and whether the stand-in of NULL is among the keys."""
    low: datetime | None
    high: datetime | None
    stand_in: bool = False


def bounds_of(spec: TableSpec) -> list[Column]:
    """Aggregates over touched partitions that ``read_bounds`` makes ``Bounds`` of; the stand-in of NULL is no bound."""
    k = F.col("partition_key")
    real = k if spec.null_partition != "allow" else F.when(k != stand_in(spec), k)
    return [F.min(real).alias("low"), F.max(real).alias("high"), F.count(real).alias("real"), F.count(F.lit(1)).alias("n")]


def read_bounds(values: Mapping, spec: TableSpec) -> Bounds:
    return Bounds(values.get("low"), values.get("high"), spec.null_partition == "allow" and values["n"] > values["real"])


def touched_bounds(touched: DataFrame, spec: TableSpec) -> Bounds:
    """The bounds of touched partitions (one row to the driver)."""
    return read_bounds(touched.agg(*bounds_of(spec)).first().asDict(), spec)


def stand_in(spec: TableSpec) -> Column:
    return partition_key(ntz_lit(NULL_PARTITION_DEFAULT), spec.partition_unit)


def _scope_key(target: DataFrame, spec: TableSpec) -> tuple[Column, Column]:
    """(key compared with touched values, NULL test) - on the physical partition
    column when the target has one, so the filter prunes directories."""
    pc = spec.partition_column
    if pc and pc in target.columns:
        return q(pc), q(pc).isNull()
    return partition_key(q(spec.partition_field), spec.partition_unit), q(spec.partition_field).isNull()


def scope_value(key: Column, spec: TableSpec, physical: bool) -> Column:
    """A touched key in the type that it is compared in: the partition column's, or as is."""
    if not physical:
        return key
    return F.date_format(key, "yyyyMMddHH").cast("int") if spec.partition_unit == "HOUR" else F.to_date(key)


def split_scope(target: DataFrame, spec: TableSpec, touched: DataFrame,
                bounds: Bounds | None = None) -> tuple[DataFrame, DataFrame]:
    """M6: (target rows the merge may match, target rows left as they are).

    ``touched`` is a frame as from ``touched_partitions_frame``. Its ``bounds``, where
    known, limit the scan of the first part (``PartitionFilters`` on a partition column).
    With NULL partitions allowed and a partition column, the first part is two scans: the touched partitions,
    semi-joined (so that the scan can be pruned by them at run time), and the NULL partition alone. Without one
    there are no folders to choose from, and one pass marks both.
    """
    if not spec.partition_field:
        return target, target.limit(0)
    key, is_null = _scope_key(target, spec)
    physical = bool(spec.partition_column and spec.partition_column in target.columns)
    allow = spec.null_partition == "allow"
    near = target
    if bounds:
        value = lambda c: scope_value(c, spec, physical)
        within = F.lit(False) if bounds.low is None else key.between(value(ntz_lit(bounds.low)), value(ntz_lit(bounds.high)))
        within = within | (key == value(stand_in(spec))) if bounds.stand_in else within
        near = target.where(within | is_null if allow and not physical else within)
    keys = touched.select(scope_value(F.col("partition_key"), spec, physical).alias("__touched"))
    same = F.col("__scope_key") == F.col("__touched")
    if allow and not physical:
        marked = near.withColumn("__scope_key", key).join(keys.withColumn("__in", F.lit(True)), same, "left")
        inside = marked.where(F.col("__in") | is_null).drop("__in", "__touched", "__scope_key")
    else:
        inside = near.withColumn("__scope_key", key).join(keys, same, "left_semi").drop("__scope_key")
    rest = target.withColumn("__scope_key", key).join(keys, same, "left_anti").drop("__scope_key")
    if allow:
        rest = rest.where(~is_null)
        inside = inside.unionByName(target.where(is_null)) if physical else inside
    return inside, rest


def guard_explicit(t: Column, s: Column, col: str) -> Column:
    """M2: ``TARGET.c < SOURCE.c`` (strict)."""
    return t[col] < s[col]


def guard_default(t: Column, s: Column, ordering: Sequence[str]) -> Column:
    """M3: first ordering column: source not NULL and ``TARGET.c <= SOURCE.c``;
    a NULL target value is never updated."""
    c = ordering[0]
    return s[c].isNotNull() & (t[c] <= s[c])


def merge_guard(t: Column, s: Column, spec: TableSpec) -> Column:
    if spec.matched:
        g = guard_explicit(t, s, spec.matched)
    elif spec.ordering:
        g = guard_default(t, s, spec.ordering)
    else:
        g = F.lit(True)
    return F.coalesce(g, F.lit(False))


def _source_value(s: Column, col: str, spec: TableSpec, dtype) -> Column:
    v = s[col]
    if col in spec.casts:
        v = v.cast(spark_type(spec.casts[col]))
    return v.cast(dtype)


def update_values(t: Column, s: Column, target: DataFrame, columns: Sequence[str],
                  spec: TableSpec) -> dict[str, Column]:
    """M4: per target column, the value after an update."""
    out = {}
    for f in target.schema.fields:
        c = f.name
        if c not in columns or c in spec.never_update:
            out[c] = t[c]
        elif c in spec.keep_if_null:
            out[c] = F.coalesce(_source_value(s, c, spec, f.dataType), t[c])
        else:
            out[c] = _source_value(s, c, spec, f.dataType)
    return out


def insert_values(s: Column, target: DataFrame, columns: Sequence[str],
                  spec: TableSpec) -> dict[str, Column]:
    """M5: per target column, the inserted value (NULL for columns not in the list)."""
    return {f.name: (_source_value(s, f.name, spec, f.dataType) if f.name in columns
                     else F.lit(None).cast(f.dataType))
            for f in target.schema.fields}


def _any_null(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def source_keys(source: DataFrame, spec: TableSpec) -> DataFrame:
    """The keys (``__sk0``, ...) that the merge compares with the target's."""
    cast = lambda k: q(k).cast(spark_type(spec.casts[k])) if k in spec.casts else q(k)
    return source.select(*[cast(k).alias(f"__sk{i}") for i, k in enumerate(spec.primary_keys)])


def merge_rows(target_in: DataFrame, source: DataFrame, spec: TableSpec,
               columns: Sequence[str] | None = None, inserted: str | None = None) -> DataFrame:
    """M1 core: merge a deduplicated source into the in-scope target rows. ``inserted`` names a column that is true
    for the rows the target did not have."""
    tcols = target_in.columns
    columns = list(columns or tcols)
    missing = [c for c in columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks merge columns {missing}")
    keys = list(spec.primary_keys)
    skey = [(q(k).cast(spark_type(spec.casts[k])) if k in spec.casts else q(k)) for k in keys]
    tkey = [q(k) for k in keys]

    t_nullkey = target_in.where(_any_null(tkey))
    t = target_in.where(~_any_null(tkey)).select(
        F.struct(*[q(c) for c in tcols]).alias("t"), *[k.alias(f"__tk{i}") for i, k in enumerate(tkey)])
    s = source.select(
        F.struct(*[q(c) for c in source.columns]).alias("s"), *[k.alias(f"__sk{i}") for i, k in enumerate(skey)])
    if any(k in spec.casts for k in keys):
        # Casting the keys can make two deduplicated source rows equal. The count
        # is a window on the join key (its exchange is the join's), and the error sits
        # in the source struct that every output branch reads.
        n = F.count(F.lit(1)).over(Window.partitionBy(*[F.col(f"__sk{i}") for i in range(len(keys))]))
        msg = F.lit("more than one source row per key after the key casts")
        whole = ~_any_null([F.col(f"__sk{i}") for i in range(len(keys))])
        s = s.withColumn("s", F.when(whole & (n > 1), F.raise_error(msg)).otherwise(F.col("s")))
    cond = [F.col(f"__tk{i}") == F.col(f"__sk{i}") for i in range(len(keys))]
    joined = t.join(s, cond, "full_outer")

    tc, sc = F.col("t"), F.col("s")
    upd = update_values(tc, sc, target_in, columns, spec)
    ins = insert_values(sc, target_in, columns, spec)
    guard = merge_guard(tc, sc, spec)
    merged = joined.select(*[
        F.when(tc.isNull(), ins[c]).when(sc.isNotNull() & guard, upd[c]).otherwise(tc[c]).alias(c)
        for c in tcols], *([tc.isNull().alias(inserted)] if inserted else []))

    return merged.unionByName(t_nullkey.withColumn(inserted, F.lit(False)) if inserted else t_nullkey)


def merge_upsert(target: DataFrame, source: DataFrame, spec: TableSpec,
                 columns: Sequence[str] | None = None, touched: DataFrame | None = None,
                 source_slice: DataFrame | None = None, scope: str = "touched") -> DataFrame:
    """M1: the whole new snapshot (rows outside the scope pass through unchanged).

    ``touched`` defaults to the partitions of ``source_slice`` (the un-deduplicated
    slice), else of ``source``; they are written to a small scratch table, so that the
    merge itself reads the slice once. ``scope="all"`` matches against every target row.
    """
    if scope == "all" or not spec.partition_field:
        return merge_rows(target, source, spec, columns)
    if touched is None:
        touched = written(touched_partitions_frame(source if source_slice is None else source_slice, spec), "touched")
    inside, rest = split_scope(target, spec, touched, touched_bounds(touched, spec))
    return merge_rows(inside, source, spec, columns).unionByName(rest)

"""Catalog resolution and membership joins.

All joins are equi-joins planned by Catalyst/AQE. Dimension sides are broadcast
only behind a size check (``broadcast_if_small``); anything larger is left to a
shuffle join.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .project import q

BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (file sizes for scans)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no estimate available (e.g. remote session)
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only when the estimated size is known and under ``max_bytes``;
    otherwise the frame is returned as is and Catalyst/AQE choose the join."""
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def catalog_join(jobs: DataFrame, dependency: DataFrame, details: DataFrame, servers: DataFrame,
                 logic: DataFrame, systems: DataFrame, chain_name: str) -> DataFrame:
    """Jobs of one scheduler chain with dependency, details, both servers, logic
    module and system; the two activity flags are named apart.

    A job with dependencies keeps a row for each that is active or has no flag (none, if
    all are inactive); a job without any keeps one row with no dependency. The first
    kind is an inner join, which adaptive execution can split where one job has a large
    share of the dependencies; the second is an anti-join on distinct keys. Details
    without both servers, a module and a system drop out, so that they are inner joins.
    """
    chain = jobs.where((q("scheduler_chain_name") == chain_name) & (q("is_active") == "Y"))
    chain = chain.withColumnRenamed("is_active", "job_is_active")
    usable = dependency.where(F.coalesce(q("is_active"), F.lit("Y")) == "Y").select(
        "job_key", "related_job_key", q("is_active").alias("dependency_is_active"))
    none = [F.lit(None).cast(usable.schema[c].dataType).alias(c) for c in ("related_job_key", "dependency_is_active")]
    alone = chain.join(dependency.select("job_key").distinct(), "job_key", "left_anti").select("*", *none)
    tied = chain.join(broadcast_if_small(usable), "job_key").unionByName(alone)

    def server(side: str) -> DataFrame:
        return broadcast_if_small(servers.select(q("application_server_key").alias(f"{side}_application_server_key"),
                                                 q("server_attributes").alias(f"{side}_server_attributes")))
    placed = details.select("job_key", "data_entity_key", "source_application_server_key", "target_application_server_key")
    module = logic.select("logic_module_key", q("logic_module_type_code").alias("job_type"), q("logic_body").alias("logic_attributes"))
    out = (tied.join(broadcast_if_small(placed), "job_key")
           .join(server("source"), "source_application_server_key")
           .join(server("target"), "target_application_server_key")
           .join(broadcast_if_small(module), "logic_module_key")
           .join(broadcast_if_small(systems.select("application_system_key", "system_attributes")), "application_system_key"))
    return out.select(*CATALOG_COLUMNS)


# The columns that the rest of the catalog code reads.
CATALOG_COLUMNS = ("job_key", "job_name", "application_system_key", "job_frequency_code", "data_entity_key",
                   "source_application_server_key", "target_application_server_key", "related_job_key",
                   "job_is_active", "dependency_is_active", "scheduler_job_name", "job_attributes",
                   "source_server_attributes", "target_server_attributes", "system_attributes", "job_type",
                   "logic_attributes")


def exclude_listed(df: DataFrame, listed: DataFrame, key: str, listed_key: str | None = None) -> DataFrame:
    """Drop rows whose key is in the list (any size: left-anti join)."""
    lk = listed_key or listed.columns[0]
    # distinct first: a map-side partial aggregate, so a key repeated in a third of
    # the list collapses before the shuffle instead of skewing the anti-join
    return df.join(listed.select(q(lk).alias("__k")).distinct(), q(key) == F.col("__k"), "left_anti")


def exclude_flagged(df: DataFrame, flags: Sequence[str], value: str = "Y") -> DataFrame:
    """Drop rows with any of the flag columns set (``is_skip='Y'``, ``is_hold='Y'``)."""
    cond = F.lit(False)
    for f in flags:
        cond = cond | F.coalesce(q(f) == F.lit(value), F.lit(False))
    return df.where(~cond)


def without_committed_run(df: DataFrame, runs: DataFrame, keys: Sequence[str] = ("job_key", "job_runtime_ms"),
                          status_col: str = "job_status_code", status: str = "COMMITTED") -> DataFrame:
    """Rows for which no run with status ``COMMITTED`` exists on the same keys."""
    done = runs.where(q(status_col) == F.lit(status)).select(*[q(k) for k in keys]).distinct()
    return df.join(done, list(keys), "left_anti")


def roots(nodes: DataFrame, edges: DataFrame, key: str = "job_key",
          related: str = "related_job_key", active_col: str | None = None) -> DataFrame:
    """Nodes no active edge points to. An edge (job, related job) makes ``job``
    depend on ``related``; jobs with such an edge are not roots."""
    e = edges.where(q(related).isNotNull())
    if active_col:
        e = e.where(q(active_col) == "Y")
    return nodes.join(e.select(q(key).alias("__dep")).distinct(), q(key) == F.col("__dep"), "left_anti")


def held_entities(jobs: DataFrame, systems: DataFrame, servers: DataFrame,
                  system_key: str = "application_system_key",
                  source_server: str = "source_application_server_key",
                  target_server: str = "target_application_server_key",
                  server_key: str = "application_server_key") -> DataFrame:
    """Jobs whose system or either server is inactive (``is_active = 'N'``).

    Each inactive-key list is distinct, so the left joins never multiply job rows.
    """
    inactive_sys = systems.where(q("is_active") == "N").select(q(system_key).alias("__sys")).distinct() \
        .withColumn("__sys_hold", F.lit(True))
    inactive_srv = servers.where(q("is_active") == "N").select(q(server_key).alias("__srv")).distinct()
    src = inactive_srv.select(F.col("__srv").alias("__src"), F.lit(True).alias("__src_hold"))
    tgt = inactive_srv.select(F.col("__srv").alias("__tgt"), F.lit(True).alias("__tgt_hold"))
    # the key lists come from the system / server dimensions: broadcast when the
    # size estimate says they are small, else shuffle joins
    j = (jobs.join(broadcast_if_small(inactive_sys), q(system_key) == F.col("__sys"), "left")
             .join(broadcast_if_small(src), q(source_server) == F.col("__src"), "left")
             .join(broadcast_if_small(tgt), q(target_server) == F.col("__tgt"), "left"))
    held = F.coalesce(F.col("__sys_hold"), F.lit(False)) | F.coalesce(F.col("__src_hold"), F.lit(False)) \
        | F.coalesce(F.col("__tgt_hold"), F.lit(False))
    return j.where(held).select(*jobs.columns)

"""Retention candidates (R1): files past their retention, listed, never deleted.

Rules come from a ``{suffix: {directories, recursive_directories, retention_days}}``
config. Matching is an equi-join: every file explodes into its ancestor folders
(bounded by path depth), which join the rule folders; a plain folder matches only
a file's own parent, a recursive folder any ancestor.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import broadcast_if_small

# File names holding this text are never candidates.
PROTECTED_TEXT = "connection_pool"


def rules_frame(spark: SparkSession, config: Mapping[str, Mapping]) -> DataFrame:
    """The rule config as rows ``suffix, directory, recursive, retention_days``."""
    rows = []
    for suffix, rule in config.items():
        days = int(rule["retention_days"])
        rows += [(suffix, d.rstrip("/") or "/", False, days) for d in rule.get("directories", [])]
        rows += [(suffix, d.rstrip("/") or "/", True, days) for d in rule.get("recursive_directories", [])]
    return spark.createDataFrame(rows, "suffix string, directory string, recursive boolean, retention_days int")


def _plain_path(col) -> F.Column:
    return F.regexp_replace(col, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def retention_candidates(inventory: DataFrame, rules: DataFrame, now) -> DataFrame:
    """Distinct files whose path ends with a rule's suffix, lacks
    ``connection_pool``, sits in the rule's folder (or below it for recursive
    folders) and was modified more than ``retention_days`` before ``now``."""
    files = inventory.select(_plain_path(F.col("path")).alias("file"), "modificationTime")
    parts = F.split(F.regexp_extract("file", r"^(.*)/[^/]*$", 1), "/")   # of "/a/b": "", "a"
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)),
                            lambda i: F.struct(F.when(i == 1, F.lit("/")).otherwise(F.array_join(F.slice(parts, 1, i), "/")).alias("dir"),
                                               (i == F.size(parts)).alias("is_parent")))
    expanded = files.select("file", "modificationTime", F.explode(ancestors).alias("a"))
    r = broadcast_if_small(rules)
    j = expanded.join(r, F.col("a.dir") == r["directory"])
    cutoff = F.lit(now).cast("timestamp") - F.make_dt_interval(F.col("retention_days"))
    keep = ((F.col("a.is_parent") | F.col("recursive")) & F.col("file").endswith(F.col("suffix"))
            & ~F.col("file").contains(PROTECTED_TEXT) & (F.col("modificationTime") < cutoff))
    return j.where(keep).select("file").distinct()

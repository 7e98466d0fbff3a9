"""File listings as frames (S8, S9). ``file_inventory`` lists by Spark's ``binaryFile`` source with column pruning, so
file contents are never read; the driver holds its list. ``list_tree`` lists in tasks."""

from __future__ import annotations

from typing import Iterator, Sequence
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written


def file_inventory(spark: SparkSession, path: str, suffix: str | None = None) -> DataFrame:
    """Every file under ``path`` (recursive) with its base name, modification
    time and size; entries with an empty base name are skipped."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
          .select("path", "modificationTime", "length"))
    df = df.withColumn("name", F.regexp_extract("path", r"([^/]*)$", 1)).where(F.col("name") != "")
    if suffix:
        df = df.where(F.col("name").endswith(suffix))
    return df


def distinct_folders(inventory: DataFrame, prefix: str | None = None) -> DataFrame:
    """Distinct parent folders of the listed files (optionally under a prefix)."""
    folders = inventory.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"))
    if prefix:
        folders = folders.where(F.col("folder").startswith(prefix))
    return folders.distinct()


TREE_SCHEMA = "path string, modificationTime timestamp, length bigint, is_folder boolean"


def _listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Folders -> their entries, one level deep."""
    for pdf in batches:
        for folder in pdf["path"]:
            scheme, rest = folder.split(":", 1)
            if scheme == "file":                       # Hadoop writes file:/x, Arrow reads file:///x
                store, at = fs.FileSystem.from_uri("file://" + "/" + quote(rest.lstrip("/")))
                name = lambda path: "file:" + path
            else:
                store, at = fs.FileSystem.from_uri(folder)
                host = rest.lstrip("/").split("/", 1)[0]
                name = lambda path: f"{scheme}://" + (path if path.startswith(host) else host + "/" + path.lstrip("/"))  # noqa: B023, E731
            found = store.get_file_info(fs.FileSelector(at, recursive=False))
            rows = [(name(f.path), f.mtime, f.size if f.is_file else None, not f.is_file) for f in found
                    if not f.base_name.startswith(("_", "."))]
            if rows:
                yield pd.DataFrame({"path": [r[0] for r in rows], "modificationTime": pd.to_datetime([r[1] for r in rows], utc=True),
                                    "length": pd.array([r[2] for r in rows], dtype="Int64"), "is_folder": [r[3] for r in rows]})


def list_tree(spark: SparkSession, roots: Sequence[str] | DataFrame, suffix: str | None = None) -> DataFrame:
    """S8 for trees of many files: the rows of ``file_inventory`` (and empty files), listed by the tasks. Folders are rows: each level's are
    dealt over the tasks, which list them and write what they find; the folders found are the next level. The driver sees neither
    files nor folders. ``roots`` are Hadoop paths (``file:/x``, ``s3://bucket/x``), as a list or a column ``path``."""
    level = roots.select("path") if isinstance(roots, DataFrame) else spark.createDataFrame([(r,) for r in roots], "path string")
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    out = None
    while True:
        found = written(level.repartition(width, "path").mapInPandas(_listed, TREE_SCHEMA), "tree_level")
        files = found.where("NOT is_folder").drop("is_folder")
        out = files if out is None else out.unionByName(files)
        level = found.where("is_folder").select("path")
        if level.isEmpty():
            break
    out = out.withColumn("name", F.regexp_extract("path", r"([^/]*)$", 1))
    return out.where(F.col("name").endswith(suffix)) if suffix else out

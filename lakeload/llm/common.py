"""Helpers shared by the operators: input tables, narrow scratch tables, checks of column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.session import scratch_dir


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared scratch area and read it back.

    Cuts the lineage with a table that outlives any executor, so later passes read these
    (narrow) rows instead of the texts.
    """
    path = scratch_dir(df.sparkSession, f"llm_{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt_once(df: DataFrame, parts: int, key: str) -> DataFrame:
    """``df`` hash-partitioned by ``key`` and checkpointed, so that later groupings by it need no shuffle.

    A checkpoint keeps its partitioning only if it was planned without adaptive execution, which is
    therefore off while this one table is written.
    """
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return df.repartition(parts, key).checkpoint()
    finally:
        conf.set(name, before)


def shuffle_width(spark: SparkSession) -> int:
    """Partitions that the session gives to a shuffle; every bucket count here follows it."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def long_id(name: str = "doc_id"):
    """The id as a long; NULL ids stay NULL."""
    return F.col(name).cast("long")


#: Bytes of a text to words: A-Z become a-z, every other ASCII byte that is no letter or digit a blank.
_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of a-z, 0-9 and characters beyond ASCII after lower-casing A-Z, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()

"""Operator 2: contiguous, byte-balanced shards from per-partition totals.

Law ``bytes``: documents stand in the order (doc_id, text_crc32, size), NULL ids last. Their sizes
have a global running sum; the total is cut at ``shards`` equal targets, and a document goes to the
shard in which its middle byte falls. A shard's bytes therefore differ from total / shards by less than
the two documents at its ends, and every shard is one contiguous range of the order.

The running sum is never taken in one task. Rows are range-partitioned, each range gets its total, the
totals (one row per range) get prefix sums, and each range adds its own running sum to its prefix.
Slots work the same way from the counts of each (range, shard).

Defined results: a NULL text has size 1 and the CRC of no bytes (0); an empty one too; an empty table
gives no rows; repeated rows are rows of their own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeload.llm.common import long_id, read_table, shuffle_width, stored
from lakeload.plans.registry import crc32_sql

SHARDS = 8


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                   ranges: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(long_id(id_col).alias("doc_id"),
                         (F.octet_length(text).cast("long") + 1).alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_crc32").asc(), F.col("size").asc()]
    ranged = narrow.repartitionByRange(ranges or shuffle_width(spark), *order)
    rows = stored(ranged.withColumn("bucket", F.spark_partition_id()), "shard_rows")

    # one row per range: what lies before it, and the size of everything
    by_bucket = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = (rows.groupBy("bucket").agg(F.sum("size").alias("bytes"))
              .select("bucket", F.coalesce(F.sum("bytes").over(by_bucket), F.lit(0)).alias("before"),
                      F.sum("bytes").over(everything).alias("total")))

    inside = Window.partitionBy("bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    middle = 2 * F.col("start") + F.col("size")          # twice the middle byte's offset
    cut = (rows.join(F.broadcast(totals), "bucket")      # bound: one row per range
           .withColumn("start", start)
           .withColumn("shard", F.least(F.lit(shards - 1),
                                        F.floor(middle / (2 * F.col("total")) * shards)).cast("int")))

    ahead = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = (cut.groupBy("bucket", "shard").agg(F.count(F.lit(1)).alias("n"))
              .select("bucket", "shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first_slot")))
    place = Window.partitionBy("bucket", "shard").orderBy(*order)
    return (cut.join(F.broadcast(counts), ["bucket", "shard"])   # bound: ranges + shards - 1 rows
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("first_slot") + F.row_number().over(place) - 1).alias("slot")))


def op2_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = shard_by_bytes(read_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


OP2_SQL = f"""WITH {crc32_sql("SELECT coalesce(text, '') AS text FROM documents")},
d AS (SELECT doc_id, strlen(coalesce(d.text, '')) + 1 AS size, crc AS text_crc32 FROM documents d JOIN crcs ON crcs.text = coalesce(d.text, '')),
o AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, text_crc32, size) AS place FROM d),
s AS (SELECT *, coalesce(sum(size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, sum(size) OVER () AS total FROM o),
c AS (SELECT *, least(7, floor((2 * start + size)::DOUBLE / (2 * total)::DOUBLE * 8))::INTEGER AS shard FROM s)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot,
       NULL::INTEGER AS grown_shard FROM c"""

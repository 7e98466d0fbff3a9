"""Connector and JDBC reads.

The source query runs in the source system; Spark only receives its result.
Connector options (URLs, accounts, warehouses) are passed in by the caller and
credentials come from the cluster's secret handling, never from this code.
"""

from __future__ import annotations

import re
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

# Connector formats that accept a source query as the "query" option,
# and the option that turns the connector's own plan pushdown off.
QUERY_FORMATS = ("jdbc", "net.snowflake.spark.snowflake", "snowflake", "bigquery",
                 "com.google.cloud.spark.bigquery", "lakeload_warehouse")
PUSHDOWN_OFF = {"net.snowflake.spark.snowflake": ("autopushdown", "off"),
                "snowflake": ("autopushdown", "off")}


def scan_connector(spark: SparkSession, fmt: str, options: Mapping[str, str], query: str | None = None,
                   view_name: str = "source", takes_query: bool | None = None) -> DataFrame:
    """Run ``query`` through a Spark connector with its pushdown off.

    Formats that take a ``query`` option (``QUERY_FORMATS``, or by ``takes_query``) get it
    as is. For file formats the query
    refers to the loaded frame as ``{source}`` (``view_name``) and Spark plans it.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt in PUSHDOWN_OFF:
        reader = reader.option(*PUSHDOWN_OFF[fmt])
    if query is None:
        return reader.load()
    if fmt in QUERY_FORMATS if takes_query is None else takes_query:
        return reader.option("query", query).load()
    # file formats: the query names the loaded frame as {source}
    return spark.sql(query, **{view_name: reader.load()})


def sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def bind_params(query: str, params: Mapping[str, object] | None) -> str:
    """Named ``:name`` parameters -> SQL literals (quotes doubled). String literals,
    quoted names and ``::type`` casts are left as they are."""
    if not params:
        return query
    token = r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|::|:([A-Za-z_][A-Za-z0-9_]*)"
    return re.sub(token, lambda m: sql_literal(params[m.group(1)]) if m.group(1) in params else m.group(0), query)


def jdbc_options(url: str, query: str, params: Mapping[str, object] | None = None,
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None, fetch_size: int = 10_000,
                 driver: str | None = None) -> dict[str, str]:
    """Options of a JDBC read. With a partition column, its bounds and a partition count
    (all four or none) the query becomes a sub-select that Spark splits into range
    reads; without them it is one task's read, which suits small results only."""
    split = (partition_column, lower, upper, num_partitions)
    if any(v is not None for v in split) and any(v is None for v in split):
        raise ValueError("a parallel read needs partition_column, lower, upper and num_partitions")
    opts = {"url": url, "fetchsize": str(fetch_size)}
    if driver:
        opts["driver"] = driver
    bound = bind_params(query, params)
    if partition_column is not None:
        opts.update({"dbtable": f"({bound}) q", "partitionColumn": partition_column,
                     "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(num_partitions)})
    else:
        opts["query"] = bound
    return opts


def scan_jdbc(spark: SparkSession, url: str, query: str, params: Mapping[str, object] | None = None,
              **kw) -> DataFrame:
    """Parametrised query on a database through Spark's JDBC source."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, params, **kw)).load()

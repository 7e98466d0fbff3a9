"""Connected components of links: in one task while they are few, else by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakeload.llm.common import stored

FEW = 1 << 21          # links that one task joins (32 MB of ids); beyond, joins and aggregates do


def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All links in one task: smallest label around, taken over by whole trees, until nothing changes."""
    pairs = [pdf.to_numpy(np.int64) for pdf in batches]
    if not pairs:
        return
    nodes, ends = np.unique(np.concatenate(pairs), return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        for at in (a, b, label[a], label[b]):
            np.minimum.at(new, at, least)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    yield pd.DataFrame({"node": nodes, "root": nodes[label]})


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """(a, b), a > b: every node ties its larger (smaller) neighbours to the smallest one it knows."""
    if small:
        near = edges.select(F.col("a").alias("n"), F.col("b").alias("v"))            # b < a
    else:
        near = edges.select(F.col("a").alias("n"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("n"), F.col("a").alias("v")))
    least = near.groupBy("n").agg(F.min("v").alias("m")).withColumn("m", F.least("n", "m"))
    joined = near.join(least, "n")
    if small:
        tied = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    else:
        tied = joined.where("v > n").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return tied.where("a <> b").distinct()


def components(links: DataFrame, few: int = FEW) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node of its component. The links are
    a stored table, as they are read twice.

    Of at most ``few`` links, a fixed number, one task takes all. Beyond it each round shortens paths by a constant factor and
    is one job; a checksum observed while it writes tells when nothing changes any more. Hubs are only ever aggregated
    (partial minima) or joined, never collected.
    """
    links = links.where("a <> b")
    if links.count() <= few:
        return stored(links.coalesce(1).mapInPandas(joined, "node long, root long"), "components")
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    seen = None
    while True:
        sums = Observation()
        edges = _star(_star(edges, small=False), small=True)
        edges = stored(edges.observe(sums, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                                     F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 30))).alias("s")), "components")
        if sums.get == seen or not sums.get["n"]:
            break
        seen = sums.get
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()

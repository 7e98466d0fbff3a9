"""Operator 5: exact top-k inner products by the three-phase uniform threshold.

A vector of d integers is cut into ``LISTS`` runs of components; a run's inner product with the query is
one local score, and a candidate's score is the sum of its local scores.

1. Gather: every task takes the k best local scores of each list; the candidates so found are scored in full,
   and the k best full scores per query are sent.
2. Cut off: the k-th best score sent for a query is a safe cutoff t, as k candidates reach it. A candidate
   whose sum reaches t has a local score of at least t / LISTS in some list. Tasks get t with the queries and collect
   every entry with such a local score in any list.
3. Resolve: the collected entries are summed exactly, those below t dropped. A task keeps the k best of a query, ties to
   the smaller id, whatever the number of equal scores; of these the k best are the answer. Nothing that belongs to it
   can be missed.

Queries are a stated set, taken in blocks of about ``BLOCK``: a block is sent to all tasks, which read the
candidates where they lie, so no candidate is shuffled. Within a batch candidates stand by their length, and a run of
them is passed over in phase 2 when, by the lengths of the lists, none of it can reach a cutoff. Local products are exact in
float64 while all sums stay under 2**53; beyond that, Python integers are used. A component or a score beyond 64 bits fails
the job.

Defined results: rows with a NULL id take no part, nor do vectors that are NULL or hold NULL or non-finite
components; every row of a repeated id is a query and a candidate, one answer holds
the best of all queries of an id, and a query never meets its own id; vectors meet only
vectors of their own length, and empty vectors score 0; fewer candidates than k give all of them; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeload.llm.common import read_table, stored
from lakeload.session import scratch_dir

TOP = 5
LISTS = 8
BLOCK = 16384         # queries that go to the tasks at once
TILE, STEP = 1024, 2048  # queries and candidates that meet at once within a task
LOWEST = -(1 << 63)


def whole_vectors(table: DataFrame, scale: int = 256) -> DataFrame:
    """(row, vec_id, dim, v): finite vectors as floor(scale * x). ``row`` numbers the rows; store them before use."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))

    def whole(c):
        y = F.floor(c * float(scale))
        return F.when(F.abs(c * float(scale)) < 2.0 ** 63, y).otherwise(F.raise_error(F.lit("a component passes 64 bits")).cast("long"))
    return (table.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & finite)
            .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                    F.size("embedding").alias("dim"), F.transform(x, whole).alias("v")))


def _matrix(vectors, d: int) -> np.ndarray:
    return np.array([*vectors], dtype=np.int64).reshape(len(vectors), d)


def _exact(q: np.ndarray, c: np.ndarray, lists: int) -> tuple[np.ndarray, np.ndarray]:
    """Both as float64 if no sum of products, nor its multiple by the lists, can leave its exact integers, else as Python integers."""
    most = lambda m: int(max(abs(int(m.max())), abs(int(m.min())))) if m.size else 0
    kind = np.float64 if most(q) * most(c) * max(1, q.shape[1]) * lists < 1 << 53 else object
    return q.astype(kind), c.astype(kind)


def _lists(d: int, lists: int) -> list[tuple[int, int]]:
    edges = np.linspace(0, d, min(lists, max(1, d)) + 1).astype(int)
    return list(zip(edges[:-1], edges[1:]))


def _lengths(m: np.ndarray, runs) -> np.ndarray:
    """Length of each vector's lists, rounded up so that products of lengths bound the inner products."""
    return np.stack([np.sqrt((m[:, a:b].astype(np.float64) ** 2).sum(axis=1)) for a, b in runs], axis=1) * (1 + 1e-9)


class Block:
    """Queries of one block by the length of their vectors, with what the phases keep for each."""

    def __init__(self, rows: list[tuple[int, int, list]], lists: int, k: int):
        self.k, self.lists = k, lists
        self.row = np.array([r for r, _, _ in rows], np.int64)
        self.vec_id = np.array([i for _, i, _ in rows], np.int64)
        dims = np.array([len(v) for _, _, v in rows], np.int64)
        self.groups = {int(d): np.flatnonzero(dims == d) for d in np.unique(dims)}
        self.matrix = {d: _matrix([rows[i][2] for i in at], d) for d, at in self.groups.items()}
        self.cutoff = np.full(len(rows), LOWEST, np.int64)

    def tiles(self, pdf: pd.DataFrame) -> Iterator[tuple]:
        """(places of queries, q, vec_ids, c, runs): tiles of queries and steps of candidates of the same length."""
        for d, own in pdf.groupby("dim", sort=False):
            if d not in self.groups:
                continue
            c = _matrix(own["v"].to_numpy(), d)
            order = np.argsort(-(c.astype(np.float64) ** 2).sum(axis=1), kind="stable")
            c, ids = c[order], own["vec_id"].to_numpy(np.int64)[order]
            q, c = _exact(self.matrix[d], c, self.lists)
            for at in range(0, len(ids), STEP):
                for lo in range(0, len(q), TILE):
                    yield self.groups[d][lo:lo + TILE], q[lo:lo + TILE], ids[at:at + STEP], c[at:at + STEP], _lists(d, self.lists)

    def gather(self, pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, id, score) of the candidates with a local score among the k best of a list."""
        for places, q, ids, c, runs in self.tiles(pdf):
            own = self.vec_id[places][:, None] == ids[None, :]
            best = min(self.k, len(ids))
            seen = np.zeros(own.shape, bool)
            for a, b in runs:
                local = np.where(own, np.inf, -(q[:, a:b] @ c[:, a:b].T))
                np.put_along_axis(seen, np.argpartition(local, best - 1, axis=1)[:, :best], True, axis=1)
            yield self.scored(places, q, ids, c, seen & ~own)

    def collect(self, pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, id, score) of the candidates whose score reaches the cutoff."""
        for places, q, ids, c, runs in self.tiles(pdf):
            cut = self.cutoff[places]
            reach = (_lengths(q, runs) * _lengths(c, runs).max(axis=0)[None, :]).sum(axis=1)
            some = np.flatnonzero(reach + 1 >= cut.astype(np.float64) * np.where(cut > 0, 1 - 1e-9, 1))
            if not len(some):
                continue
            places, q, cut = places[some], q[some], cut[some].astype(q.dtype)[:, None]
            enough = np.zeros((len(places), len(ids)), bool)
            for a, b in runs:                       # entries that reach their share of the cutoff
                enough |= np.asarray((q[:, a:b] @ c[:, a:b].T) * len(runs) >= cut, bool)
            query, id_, score = self.scored(places, q, ids, c, enough & (self.vec_id[places][:, None] != ids[None, :]))
            keep = score >= self.cutoff[query]
            yield query[keep], id_[keep], score[keep]

    @staticmethod
    def scored(places, q, ids, c, chosen) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, cols = np.nonzero(chosen)
        parts = [(q[r] * c[s]).sum(axis=1) for r, s in ((rows[i:i + (1 << 16)], cols[i:i + (1 << 16)]) for i in range(0, len(rows), 1 << 16))]
        total = np.concatenate(parts) if parts else np.zeros(0)
        if total.dtype == object and any(not LOWEST <= x < -LOWEST for x in total):
            raise OverflowError("a score passes 64 bits")
        return places[rows], ids[cols], total.astype(np.int64)

    def best(self, found) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best of each query, by score, then the smaller id."""
        query, id_, score = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((id_, ~score, query))             # ~ turns the order round without leaving 64 bits
        query, id_, score = query[order], id_[order], score[order]
        keep = np.arange(len(query)) - np.searchsorted(query, query) < self.k
        return query[keep], id_[keep], score[keep]

    def run(self, batches: Iterator[pd.DataFrame], phase) -> pd.DataFrame:
        held = tuple(np.zeros(0, np.int64) for _ in range(3))
        for pdf in batches:
            for found in phase(pdf):
                held = self.best([held, found])
        return pd.DataFrame({"query": self.row[held[0]], "vec_id": held[1], "score": held[2]})


def _phase(sent, name: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = sent.value
        out = block.run(batches, getattr(block, name))
        if len(out):
            yield out
    return run


def top_k(vectors: DataFrame, is_query, k: int = TOP, lists: int = LISTS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other vectors of every query; ``vectors`` as from whole_vectors, stored."""
    spark = vectors.sparkSession
    queries = vectors.where(is_query)
    blocks = max(1, -(-queries.count() // block))
    found_at = scratch_dir(spark, "llm_topk_found")
    schema = "query long, vec_id long, score long"
    candidates = vectors.select("vec_id", "dim", "v")
    best = Window.partitionBy("query").orderBy(F.desc("score"))
    for i in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == i).select("row", "vec_id", "v").toArrow()
        held = Block(list(zip(*(own[c].to_pylist() for c in ("row", "vec_id", "v")))), lists, k)
        sent = candidates.mapInPandas(_phase(spark.sparkContext.broadcast(held), "gather"), schema)
        cutoffs = sent.withColumn("r", F.row_number().over(best)).where(F.col("r") == k).select("query", "score").toArrow()
        place = {int(r): i for i, r in enumerate(held.row)}
        for query, score in zip(cutoffs["query"].to_pylist(), cutoffs["score"].to_pylist()):
            held.cutoff[place[query]] = score       # with fewer than k candidates there is none, and every entry is collected
        candidates.mapInPandas(_phase(spark.sparkContext.broadcast(held), "collect"), schema).write.mode("append").parquet(found_at)
    names = queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = spark.read.schema(schema).parquet(found_at).join(names, "query").withColumn("rank", F.row_number().over(rank))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = stored(whole_vectors(read_table(spark, sf_dir, "embeddings")), "topk_vectors")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

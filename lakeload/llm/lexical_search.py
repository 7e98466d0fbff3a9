"""Operator 12: ranked lexical search with bag deduplication.

Terms are the maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. N documents hold a
term, L is the number of all their terms, n a document's, df the documents that hold a term, tf its occurrences in one.
A term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))), a document has m = 100 - 25 + (25 * n * N) div L, and its
score for an item sums w * ((10^9 * tf) div (1000 * tf + 12 * m)) over the item's terms, repeats included.

Items are a stated query set; they are taken in blocks of about ``BLOCK_TERMS`` terms, each against all documents.

1. Restrict. One pass over the texts leaves of each document its bag: the tf of the block's terms. N, L and df follow.
2. Classes. Rows are hashed by (m, bag); equal hashes are verified by the bags themselves. A class has one score per
   item. Of its members the ``top`` smallest ids are kept: no list can hold more, and the first stands for the class.
3. Score. Each class is scored once, by the items' postings. A task keeps the ``top`` best classes per item, ties to
   the smaller first member: every class ahead has a document ahead of this one's.
4. Expand. The best classes of all tasks are replaced by their members in ascending id, and the best ``top`` kept.

A task holds a batch of bags, a block's postings and ``top`` classes per item; the driver holds one block's terms. All
but w is integer arithmetic; sums are exact in float64 below 2**53, and added as integers beyond.

Defined results: NULL and wordless texts have no term and are never returned; documents that repeat an id are documents
each, NULL ids come last among equal scores; items that repeat an id are items each; items without terms, or whose terms
no document holds, have no rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeload.llm.common import long_id, read_table, stored, words_of

TOP = 20
BLOCK_TERMS = 1 << 18
AT_ONCE = 1 << 21         # postings, and scores, that a task adds up at once
LAST = (1 << 63) - 1      # stands for a NULL id while ordering


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term, q) for every term of every item; ``item`` numbers the rows."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), long_id("item_id").alias("item_id"), F.col("text").cast("string").alias("text"))

    @F.pandas_udf("array<struct<term: binary, q: long>>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"term": k, "q": n} for k, n in Counter(words_of(t)).items()])
    return rows.select("item", "item_id", F.explode(run("text")).alias("t")).select("item", "item_id", "t.term", "t.q")


def bags(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(row, doc_id, n, bag) per document with a term; a bag is (place in ``terms``, tf) pairs of 32 bits, by place."""
    place = {t: i for i, t in enumerate(terms)}

    @F.pandas_udf("n long, bag binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for text in texts:
                words = words_of(text)
                own = sorted((place[t], tf) for t, tf in Counter(words).items() if t in place)
                out.append((len(words), np.array(own, "<u4").tobytes()))
            yield pd.DataFrame(out, columns=["n", "bag"])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), long_id().alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("row", "doc_id", run("text").alias("b")).select("row", "doc_id", "b.n", "b.bag").where("n > 0")


def document_counts(rows: DataFrame, terms: int) -> np.ndarray:
    """df of the block's terms."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(terms, np.int64)
        for pdf in batches:
            at = np.frombuffer(b"".join(pdf["bag"]), "<u4")[::2]
            df += np.bincount(at, minlength=terms)
        some = np.flatnonzero(df)
        yield pd.DataFrame({"term": some, "df": df[some]})
    found = rows.select("bag").mapInPandas(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(terms, np.int64)
    df[found["term"].to_numpy()] = found["df"].to_numpy()
    return df


def members(rows: DataFrame, m, top: int) -> DataFrame:
    """(class, m, bag, doc_id, at): of each class the ``top`` smallest ids, ``at`` from 1; the class is its first row's number."""
    hashed = rows.where(F.octet_length("bag") > 0).select("row", "doc_id", m.cast("long").alias("m"), "bag")
    hashed = hashed.withColumn("h", F.xxhash64("m", "bag"))
    same = Window.partitionBy("h", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last(), "row")
    ordered = hashed.withColumn("at", F.row_number().over(same)).withColumn("class", F.first_value("row").over(same))
    return ordered.where(F.col("at") <= top).select("class", "m", "bag", "doc_id", "at")


class Postings:
    """A block's items by term: item and weight of each posting."""

    def __init__(self, terms: int, at: np.ndarray, item: np.ndarray, weight: np.ndarray):
        order = np.argsort(at, kind="stable")
        self.item, self.weight = item[order], weight[order]
        self.starts = np.searchsorted(at[order], np.arange(terms + 1))
        self.items = int(item.max()) + 1 if len(item) else 0
        # no score passes the sum of an item's weights times the largest quotient
        self.most = int(np.bincount(item, weights=weight).max()) * 1_000_000 if len(item) else 0

    def scores(self, m: np.ndarray, of: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Score of each bag (m; entries (of, term, tf)) for each item."""
        quotient = (1_000_000_000 * tf) // (1000 * tf + 12 * m[of])
        length = self.starts[term + 1] - self.starts[term]
        at = np.repeat(self.starts[term] - np.cumsum(length) + length, length) + np.arange(length.sum())
        cell = np.repeat(of, length) * self.items + self.item[at]
        part = np.repeat(quotient, length) * self.weight[at]
        if self.most < 1 << 53:
            total = np.bincount(cell, weights=part, minlength=len(m) * self.items).astype(np.int64)
        else:
            total = np.zeros(len(m) * self.items, np.int64)
            np.add.at(total, cell, part)
        return total.reshape(len(m), self.items)


def best_classes(postings: Postings, items: np.ndarray, top: int):
    """Classes (class, m, bag, first) -> (item, class, first, score): a task's ``top`` best per item."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [np.zeros(0, np.int64) for _ in range(4)]          # item, class, first, score
        cut = np.ones(postings.items, np.int64)                   # scores below are out; a score must be above 0
        lengths = np.diff(postings.starts)
        for pdf in batches:
            name, m = pdf["class"].to_numpy(np.int64), pdf["m"].to_numpy(np.int64)
            first = pdf["first"].to_numpy(np.int64)
            sizes = pdf["bag"].map(len).to_numpy() // 8
            pairs = np.frombuffer(b"".join(pdf["bag"]), "<u4").reshape(-1, 2).astype(np.int64)
            ends = np.cumsum(sizes)
            work = np.cumsum(lengths[pairs[:, 0]])[ends - 1] + np.arange(1, len(name) + 1) * postings.items
            lo = 0
            while lo < len(name):
                hi = max(lo + 1, int(np.searchsorted(work, (work[lo - 1] if lo else 0) + AT_ONCE, side="right")))
                a, b = ends[lo] - sizes[lo], ends[hi - 1]
                of = np.repeat(np.arange(hi - lo), sizes[lo:hi])
                score = postings.scores(m[lo:hi], of, pairs[a:b, 0], pairs[a:b, 1])
                row, item = np.nonzero(score >= cut[None, :])
                if len(row):
                    fresh = (item, name[lo + row], first[lo + row], score[row, item])
                    held = [np.concatenate(x) for x in zip(held, fresh)]
                    order = np.lexsort((held[1], held[2], -held[3], held[0]))
                    held = [x[order] for x in held]
                    rank = np.arange(len(order)) - np.searchsorted(held[0], held[0])
                    cut[held[0][rank == top - 1]] = held[3][rank == top - 1]
                    held = [x[rank < top] for x in held]
                lo = hi
        held[0] = items[held[0]]
        yield pd.DataFrame(dict(zip(("item", "class", "first", "score"), held)))
    return run


def search_block(docs: DataFrame, block: DataFrame, top: int) -> DataFrame:
    """(item_id, rank, doc_id, score) of one block of items, their (item, item_id, term, q)."""
    held = block.select("item", "term", "q").toArrow().to_pandas()          # about BLOCK_TERMS rows
    terms = sorted(set(held["term"]))
    rows = stored(bags(docs, terms), "search_bags")
    n_docs, length = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = document_counts(rows, len(terms))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)

    place = {t: i for i, t in enumerate(terms)}
    at = held["term"].map(place).to_numpy(np.int64)
    items, number = np.unique(held["item"].to_numpy(np.int64), return_inverse=True)
    postings = Postings(len(terms), at, number, weight[at] * held["q"].to_numpy(np.int64))

    m = F.lit(75) + F.expr(f"(25 * n * {n_docs}L) div {length or 1}L")
    kept = stored(members(rows, m, top), "search_members")
    found = kept.where("at = 1").select("class", "m", "bag", F.coalesce("doc_id", F.lit(LAST)).alias("first")).mapInPandas(
        best_classes(postings, items, top), "item long, class long, first long, score long")
    ahead = Window.partitionBy("item").orderBy(F.desc("score"), "first", "class")
    # at most ``top`` rows for each item of the block: small by construction, like the items themselves
    winners = found.withColumn("r", F.row_number().over(ahead)).where(F.col("r") <= top).select("item", "class", "score")
    names = block.select("item", "item_id").distinct()
    rank = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    out = kept.select("class", "doc_id").join(F.broadcast(winners), "class").withColumn("rank", F.row_number().over(rank))
    return out.where(F.col("rank") <= top).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of every item."""
    terms = stored(item_terms(items), "search_items")
    blocks = max(1, -(-terms.count() // block_terms))
    found = [search_block(docs, terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i), top) for i in range(blocks)]
    return reduce(DataFrame.unionByName, found)


def op12_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT item, term, count(*) AS q FROM (SELECT item, unnest(w) AS term FROM b) GROUP BY ALL),
c AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS length FROM t WHERE len(w) > 0),
f AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM t) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
d AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM f GROUP BY term), c),
m AS (SELECT row, 75 + (25 * len(w) * n_docs) // length AS m FROM t, c WHERE len(w) > 0),
s AS (SELECT q.item, f.row, sum(q.q * d.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * m.m)))::BIGINT AS score
      FROM q JOIN d ON d.term = q.term JOIN f ON f.term = q.term JOIN m ON m.row = f.row GROUP BY ALL HAVING score > 0),
r AS (SELECT b.item_id, t.doc_id, s.score, row_number() OVER (PARTITION BY s.item ORDER BY s.score DESC, t.doc_id NULLS LAST)::INTEGER AS rank
      FROM s JOIN t ON t.row = s.row JOIN b ON b.item = s.item)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""

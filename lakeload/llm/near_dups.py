"""Operator 4: near-duplicate classes by BagMinHash, banding and exact verification.

A text is the multiset of its runs of five words (a text of one to four words is one run). The likeness of two is
the weighted Jaccard of the multisets, sum of minima over sum of maxima; texts of ``LIKENESS`` or more are linked,
and classes are the connected components of the links. Equal texts always share a class.

Signatures. Every (run, weight level) has a Poisson process of points (time, slot), drawn from a hash of the run,
and a text's signature holds the earliest time per slot. Levels form a hierarchy of dyadic intervals (0,1], (1,2],
(2,4], ...: one process per interval, whose rate is the interval's width; a point has a level within its interval
and counts only if the text's weight reaches it, so texts of different weights share exactly the points below the
smaller one. Slots then agree with a probability equal to the likeness. Points come in time order and stop once the
next are later than every slot's minimum, so a text costs about its runs plus SLOTS * ln(SLOTS) points.

Bands. ``BANDS`` keys of ``ROWS`` slots each: a pair at likeness 0.8 shares no key with probability 3e-6.

Links. Exact copies fall together first. Keys with the same head, which is their smallest number, go on as one group, whose texts travel
compressed. One task takes a group: it numbers the runs of words, compares every text with the head, and lets those that are not
linked to it meet the others by their runs beyond the head (``near_groups``). It needs one link for every two classes that
it joins, so a group gives fewer links than it has texts, however many pairs are linked.

A group of more than a fixed block goes in parts of about a block, each with the head. After that, only the texts outside the group's
largest class (of all links so far) meet the other parts, again a block of them with a part at a time. So tasks keep to two
blocks, and there are no further rounds.

So every link between texts that share a key is found, or joins one class already, while no group emits its pairs.
Verification counts the runs of words themselves, not hashes.

Defined results: a NULL text counts as empty; empty texts are copies of each other; the class id is the smallest id
of the class (NULL if all its ids are NULL); rows that repeat an id keep a row each; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeload.llm.common import long_id, read_table, stored
from lakeload.llm.components import components
from lakeload.llm.near_groups import group_links
from lakeload.llm.wordhash import BASES, U, compressed, mix, powers, rolling, word_hashes

RUN = 5
LIKENESS = 0.8
BANDS, ROWS = 32, 5
SLOTS = BANDS * ROWS
STEP = U(0x9E3779B97F4A7C15)
PAIRWISE = 1 << 13     # texts, and runs of all of them, that a part of a group has at most, but for chance
ROOM = 1 << 21


def text_key(text):
    """128-bit identity of a text."""
    return F.unhex(F.md5(text.cast("binary")))


def weighted_runs(words: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of words (as hashes) and how often each stands in the text."""
    if not len(words):
        return words, np.zeros(0, np.int64)
    return np.unique(rolling(words, min(run, len(words)), BASES[1]), return_counts=True)


def signature(runs: np.ndarray, weights: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Earliest point per slot over the hierarchical processes of all runs."""
    best = np.full(slots, np.inf)
    # one process per run and dyadic interval of levels (low, high] that the weight reaches into
    seeds, low, width, cap = [mix(runs)], [np.zeros(len(runs))], [np.ones(len(runs))], [weights.astype(float)]
    k, reach = 1, weights > 1
    while reach.any():
        seeds.append(mix(runs[reach] + U(k)))
        low.append(np.full(reach.sum(), 2.0 ** (k - 1)))
        width.append(np.full(reach.sum(), 2.0 ** (k - 1)))
        cap.append(weights[reach].astype(float))
        k, reach = k + 1, weights > 2 ** k
    seed, low, width, cap = map(np.concatenate, (seeds, low, width, cap))
    time = np.zeros(len(seed))
    drawn = 0
    chunk = int(1.2 * slots * (np.log(slots) + 1) / max(1.0, weights.sum())) + 1
    while len(seed):
        at = (np.arange(drawn, drawn + chunk, dtype=U) * U(3))[None, :] + U(1)
        draw = lambda j: mix(seed[:, None] + (at + U(j)) * STEP)
        gaps = -np.log(((draw(0) >> U(11)).astype(float) + 0.5) / 2.0 ** 53) / width[:, None]
        # one gap after the other from the earlier time on, so that a time's bits do not depend on the blocks
        times = np.cumsum(np.concatenate((time[:, None], gaps), axis=1), axis=1)[:, 1:]
        slot = (draw(1) % U(slots)).astype(np.int64)
        counts = times
        if (partial := cap < low + width).any():
            level = low[:, None] + width[:, None] * ((draw(2) >> U(11)).astype(float) + 0.5) / 2.0 ** 53
            counts = np.where(partial[:, None] & (level > cap[:, None]), np.inf, times)
        np.minimum.at(best, slot.ravel(), counts.ravel())
        drawn += chunk
        time = times[:, -1]
        on = time < best.max()
        seed, low, width, cap, time = seed[on], low[on], width[on], cap[on], time[on]
        chunk = min(1 << 12, max(chunk, 2) * 2)
    return best


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """64-bit key per text and band; the band's number is part of it."""
    raw = np.ascontiguousarray(signatures).view(U).reshape(len(signatures), bands, -1)
    mixed = mix(raw * powers(BASES[2], raw.shape[2])[None, None, :]).sum(axis=2, dtype=U)
    return mix(mixed + np.arange(1, bands + 1, dtype=U)[None, :]).view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, k, size, keys) per row: text identity, number of runs, band keys (none for an empty text)."""
    rows = (docs.select(long_id().alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .select("doc_id", text_key(F.col("text")).alias("k"), "text"))

    @F.pandas_udf("size long, keys array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            distinct = list(dict.fromkeys(texts))       # copies within a batch are signed once
            hashes, bounds = word_hashes([t.encode("utf-8", "surrogatepass") for t in distinct])
            sizes, signs, having = [], [], []
            for i, _ in enumerate(distinct):
                runs, weights = weighted_runs(hashes[bounds[i]:bounds[i + 1]])
                sizes.append(int(weights.sum()))
                if sizes[-1]:
                    having.append(i)
                    signs.append(signature(runs, weights))
            keys: list = [[] for _ in distinct]
            if signs:
                for i, own in zip(having, band_keys(np.array(signs))):
                    keys[i] = own
            place = {t: i for i, t in enumerate(distinct)}
            at = [place[t] for t in texts]
            yield pd.DataFrame({"size": [sizes[i] for i in at], "keys": [keys[i] for i in at]})
    return rows.select("doc_id", "k", run("text").alias("s")).select("doc_id", "k", "s.size", "s.keys")


def runs_of(text: bytes) -> Counter:
    words = text.split()
    if 0 < len(words) < RUN:
        return Counter([tuple(words)])
    return Counter(zip(*(words[i:] for i in range(RUN))))


def likeness(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    every = sum(a.values()) + sum(b.values()) - both
    return both / every if every else 1.0


def with_heads(members: DataFrame) -> DataFrame:
    """(node, head, size, head_size) of the groups (key, node, size), without the heads' own rows."""
    heads = members.groupBy("key").agg(F.min(F.struct("node", "size")).alias("h"), F.count(F.lit(1)).alias("n")).where("n > 1")
    heads = heads.select("key", F.col("h.node").alias("head"), F.col("h.size").alias("head_size"))
    placed = members.join(heads, "key").where("node <> head")
    return placed.select("node", "head", "size", "head_size").distinct()


def dealt_rows(rows: DataFrame, packed: DataFrame, least: float) -> DataFrame:
    """Links (a, b) found in the groups of ``rows``; ``i`` and ``j`` hold the parts of its group that a row goes to."""
    rows = rows.join(packed, "node").withColumn("i", F.explode("i")).withColumn("j", F.explode("j"))
    rows = rows.repartition("head", "i", "j").sortWithinPartitions("head", "i", "j", "node")
    return rows.select("head", "i", "j", "node", "label", "main", "turn", "size", "packed").mapInPandas(group_links(RUN, least), "a long, b long")


def parts(n: str, runs: str) -> Column:
    return F.expr(f"cast(greatest(ceil({n} / {PAIRWISE}), ceil({runs} / {ROOM})) as int)")


def part_of(count: str, seed: int) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(seed)), F.col(count)).cast("int")


def every(count: str) -> Column:
    return F.sequence(F.lit(0), F.col(count) - 1)


def links_in_parts(placed: DataFrame, groups: DataFrame, packed: DataFrame, least: float) -> DataFrame:
    """Links within each part of each group, and with the head; a group of at most a block is one part."""
    own = placed.join(groups.select("head", "m"), "head").select("head", "node", "size", F.array(part_of("m", 1)).alias("j"))
    heads = groups.select("head", F.col("head").alias("node"), F.col("head_size").alias("size"), every("m").alias("j"))
    rows = own.unionByName(heads).withColumns({"i": F.array(F.lit(0)), "label": F.col("node"), "main": F.col("head"), "turn": F.lit(True)})
    return dealt_rows(rows, packed, least)


def links_across_parts(placed: DataFrame, groups: DataFrame, packed: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """Links between the parts of the groups that have several: the texts outside a group's largest class meet every part."""
    held = placed.join(groups.where("m > 1").select("head", "m"), "head").join(roots, "node", "left").withColumn("label", F.coalesce("root", "node"))
    held = stored(held.select("head", "node", "size", "label", "m", "head_size"), "near_held")
    classes = held.groupBy("head", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("runs"))
    classes = classes.groupBy("head").agg(F.max(F.struct("n", "label")).alias("most"), (F.sum("n") - F.max("n")).alias("strays"),
                                          (F.sum("runs") - F.max(F.struct("n", "label", "runs"))["runs"]).alias("runs"))
    classes = classes.where("strays > 0").select("head", F.col("most.label").alias("main"), parts("strays", "runs").alias("k"))
    held = held.join(classes, "head")
    strays = held.where("label <> main").select("*", F.array(part_of("k", 2)).alias("i"), every("m").alias("j"), F.lit(True).alias("turn"))
    others = held.select("*", every("k").alias("i"), F.array(part_of("m", 1)).alias("j"), F.lit(False).alias("turn"))
    heads = held.groupBy("head").agg(*[F.first(c).alias(c) for c in ("m", "k", "main", "head_size")]).join(roots.select(F.col("node").alias("head"), "root"), "head", "left")
    heads = heads.select("head", F.col("head").alias("node"), F.col("head_size").alias("size"), F.coalesce("root", "head").alias("label"), "main",
                         every("k").alias("i"), every("m").alias("j"), F.lit(False).alias("turn"))
    columns = heads.columns
    return dealt_rows(heads.unionByName(strays.select(columns)).unionByName(others.select(columns)), packed, least)


def near_classes(docs: DataFrame, least: float = LIKENESS) -> DataFrame:
    """(doc_id, k, class_id, root) for every row; k identifies the text, root the class."""
    rows = stored(signed(docs), "near_signed")
    texts = rows.groupBy("k").agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("size", "keys")])
    texts = stored(texts.withColumn("node", F.monotonically_increasing_id()), "near_texts")
    placed = stored(with_heads(texts.select("node", "size", F.explode("keys").alias("key"))), "near_placed")

    # compressed texts of the candidates
    wanted = placed.select("node").union(placed.select("head")).distinct()
    wanted = texts.select("k", "node").join(wanted, "node")
    source = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text")).select(text_key(F.col("text")).alias("k"), compressed(F.col("text")).alias("packed"))
    packed = source.join(wanted, "k").groupBy("node").agg(F.first("packed").alias("packed"))
    packed = stored(packed, "near_packed")

    groups = placed.groupBy("head").agg(F.first("head_size").alias("head_size"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("runs"))
    groups = stored(groups.select("head", "head_size", parts("n", "runs").alias("m")), "near_groups")
    links = stored(links_in_parts(placed, groups, packed, least), "near_links")
    roots = components(links)
    if not groups.where("m > 1").isEmpty():
        links = links.unionByName(stored(links_across_parts(placed, groups, packed, roots, least), "near_links"))
        roots = components(links)

    named = roots.join(texts.select("node", "doc_id"), "node")
    named = named.join(named.groupBy("root").agg(F.min("doc_id").alias("class_id")), "root").select("node", "root", "class_id")
    every = texts.select("k", "node", F.col("doc_id").alias("own")).join(named, "node", "left")
    every = every.select("k", F.coalesce("root", "node").alias("root"), F.when(F.col("root").isNull(), F.col("own")).otherwise(F.col("class_id")).alias("class_id"))
    return rows.select("doc_id", "k").join(every, "k").select("doc_id", "k", "class_id", "root")


def one_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: smallest id, then smallest text identity."""
    best = classes.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k")).alias("w")).select("w.doc_id", "w.k")
    rows = docs.withColumn("__k", text_key(F.coalesce(F.col("text"), F.lit(""))))
    d, b = rows.alias("d"), best.alias("b")
    kept = d.join(b, F.expr("d.__k = b.k AND cast(d.doc_id AS bigint) <=> b.doc_id"), "left_semi")
    once = Window.partitionBy("__k").orderBy(F.lit(1))
    return kept.withColumn("__n", F.row_number().over(once)).where("__n = 1").drop("__n", "__k")


def op4_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT min(doc_id) AS id, t, any_value(w) AS w FROM d GROUP BY t),
g AS (SELECT id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS run FROM u),
c AS (SELECT id, run, count(*) AS n FROM g GROUP BY ALL),
s AS (SELECT id, sum(n) AS size FROM c GROUP BY id),
o AS (SELECT a.id AS x, b.id AS y, sum(least(a.n, b.n)) AS shared FROM c a JOIN c b ON a.run = b.run AND a.id < b.id GROUP BY ALL),
l AS (SELECT x, y FROM o JOIN s p ON p.id = x JOIN s q ON q.id = y WHERE shared >= 0.8 * (p.size + q.size - shared)),
e AS (SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l),
walk(id, root) AS (SELECT id, id FROM u UNION SELECT e.b, walk.root FROM walk JOIN e ON e.a = walk.id),
k AS (SELECT id, min(root) AS class_id FROM walk GROUP BY id)
SELECT d.doc_id, k.class_id FROM d JOIN u ON u.t = d.t JOIN k ON k.id = u.id
"""

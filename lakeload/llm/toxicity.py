"""Operator 6: toxicity by maximum-scoring segments of token log-odds.

Model. Words are hashed into ``BUCKETS`` counters of the documents that hold them (a word that one text
repeats counts once). Over all documents they give the background, over a bounded sample of labelled
training rows the toxic and the clean counts. A bucket's log-odds (toxic against clean) have a Dirichlet
prior of ``PRIOR`` pseudo-counts spread like the background; a bucket scores its
log-odds less ``CAUTION`` standard errors if that is positive, else ``DRIFT`` (below zero), so that a clean
text's running score falls. The model is one fixed array, whatever the corpus.

Scan. One linear pass per text finds all maximal scoring segments (every segment that no extension or cut
improves): toxic words that stand near each other join, those far apart stay separate.

Calibration. In clean text the best segment of n words follows an extreme-value law with
P(best < S) = exp(-K n exp(-lambda S)); lambda solves sum p exp(lambda s) = 1 over clean words, K is its
maximum-likelihood value over the clean training rows. A segment is a significant passage if fewer than
``EXPECTED`` like it are expected. The evidence of one segment is s = lambda S - ln(1 + K n); that of the r best
significant passages together follows the law of their sum T, P = exp(-T) T^(r-1) / (r! (r-1)!), as T - (r-1) ln T
+ ln(r! (r-1)!) less (r-1) ln 2 for the choice of r. A document's evidence is the largest over all r; a logistic fit
on the training rows turns it into the score.

Training rows are those whose crc32(doc_id as text) mod 5 is not 0; of them at most ``SAMPLE``, by smallest
hash of the id, are used; the fits have one row per id, its largest. Scores read nothing but the text.

Defined results: NULL and empty texts have no words, evidence of 0 length-adjusted words and a score like any
other; NULL ids count as held out; an id with several labels is toxic if one says so; without labels of both
classes every score is the share of toxic ones (0 without any); an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm.common import long_id, read_table, words_of

BUCKETS = 1 << 18
SAMPLE = 20_000       # labelled rows that the fit may use
PRIOR = 2_000.0       # pseudo-counts of the Dirichlet prior
CAUTION = 2.5         # standard errors
DRIFT = -0.08
EXPECTED = 0.05
FOLDS, HELD_OUT = 5, 0
COUNTS = ("n", "toxic", "clean", "words")


def buckets_of(text: str | None) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(crc32, words), dtype=np.int64, count=len(words)) & (BUCKETS - 1)


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments as (score, first, end), from left to right, in linear time."""
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    breaks = np.flatnonzero(np.diff(up) > 1)
    firsts = up[np.concatenate(([0], breaks + 1))].tolist()
    ends = (up[np.concatenate((breaks, [len(up) - 1]))] + 1).tolist()
    held: list[list] = []                    # [sum before, sum behind, first, end, last one with a smaller sum before]
    for first, end in zip(firsts, ends):
        low, high = float(total[first]), float(total[end])
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][0] >= low:
                j = held[j][4]
            if j < 0 or held[j][1] >= high:
                break
            low, first = held[j][0], held[j][2]   # joins with everything from j on
            del held[j:]
            j = len(held) - 1
        held.append([low, high, first, end, j])
    return [(high - low, first, end) for low, high, first, end, _ in held]


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_OUT


def training_sample(labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """At most ``most`` (doc_id, toxic) rows, those with the smallest id hashes."""
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy(long_id().alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def count_words(docs: DataFrame, sample: DataFrame) -> pd.DataFrame:
    """(bucket, n, toxic, clean, words): documents that hold the bucket's words, of all, toxic and clean rows, and
    its words in clean rows; one row per used bucket, at most BUCKETS."""
    marked = docs.select(long_id().alias("doc_id"), "text").join(F.broadcast(sample), "doc_id", "left").select("text", "toxic")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((len(COUNTS), BUCKETS), dtype=np.int64)
        for pdf in batches:
            for text, toxic in zip(pdf["text"], pdf["toxic"]):
                words = buckets_of(text)
                at, times = np.unique(words, return_counts=True)
                counts[0, at] += 1
                if toxic == 1:
                    counts[1, at] += 1
                elif toxic == 0:
                    counts[2, at] += 1
                    counts[3, at] += times
        used = np.flatnonzero(counts[0])
        yield pd.DataFrame({"bucket": used.astype(np.int32)} | {c: counts[i, used] for i, c in enumerate(COUNTS)})
    per_task = marked.mapInPandas(run, "bucket int, " + ", ".join(f"{c} long" for c in COUNTS))
    return per_task.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in COUNTS]).toPandas()


def log_odds(counts: pd.DataFrame) -> tuple[np.ndarray, float]:
    """Scores of all buckets, and lambda over clean words."""
    scores = np.full(BUCKETS, DRIFT)
    n, t, c, words = (counts[k].to_numpy(dtype=float) for k in COUNTS)
    if not t.sum() or not c.sum():
        return scores, 1.0
    prior = PRIOR * n / n.sum()
    a, b = t + prior, c + prior
    odds = np.log(a / (t.sum() + PRIOR - a)) - np.log(b / (c.sum() + PRIOR - b))
    sure = odds - CAUTION * np.sqrt(1 / a + 1 / b)
    own = np.where(sure > 0, sure, DRIFT)
    scores[counts["bucket"].to_numpy()] = own
    p = words + prior
    p /= p.sum()
    low, high = 0.0, 1.0
    while high < 64 and p @ np.exp(high * own) < 1:
        high *= 2
    for _ in range(60):                               # the sum dips below 1 first, so the root is the upper one
        mid = (low + high) / 2
        low, high = (mid, high) if p @ np.exp(mid * own) < 1 else (low, mid)
    return scores, max(high, 1e-3)


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope with a small ridge on the slope, by Newton's method."""
    rows, w = np.column_stack([np.ones(len(x)), x]), np.zeros(2)
    ridge = np.diag([1e-6, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        step = np.linalg.solve(rows.T @ (rows * (p * (1 - p))[:, None]) + ridge, rows.T @ (y - p) - ridge @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> dict:
    """The model: bucket scores, extreme-value and logistic parameters (driver: at most BUCKETS + most rows)."""
    sample = training_sample(labels, most)
    scores, lam = log_odds(count_words(docs, sample))
    model = {"scores": scores, "lam": lam, "k": 1.0, "a": 0.0, "b": 0.0, "share": 0.0}
    sampled = docs.select(long_id().alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")

    def found(*columns: str) -> pd.DataFrame:
        """(toxic, columns) of each sampled id's largest row, as an id may have many."""
        rows = (sampled.select("doc_id", "toxic", best_segment(docs.sparkSession, model)("text").alias("best"))
                .groupBy("doc_id", "toxic").agg(F.max(F.struct(*[f"best.{c}" for c in columns])).alias("best")))
        return rows.select("toxic", "best.*").orderBy("toxic", *columns).toPandas()
    rows = found("top", "n_words")
    y = rows["toxic"].to_numpy(dtype=float)
    if not 0 < y.sum() < len(y):
        return model | {"share": float(y.mean()) if len(y) else 0.0}
    n, top = np.maximum(1.0, rows["n_words"].to_numpy(dtype=float)), rows["top"].to_numpy(dtype=float)
    clean = y == 0
    model["k"] = float(clean.sum() / max(1e-12, (n[clean] * np.exp(-lam * top[clean])).sum()))
    rows = found("evidence")                             # needs K
    y = rows["toxic"].to_numpy(dtype=float)
    model["a"], model["b"] = fit_logistic(rows["evidence"].to_numpy(dtype=float), y)
    return model | {"share": float(y.mean())}


def evidence(scores: list[float], n_words: int, lam: float, k: float) -> float:
    """The largest evidence of the r best segments together, over r; only significant ones join the best."""
    room = math.log1p(k * max(1, n_words))
    own = sorted((lam * s - room for s in scores), reverse=True) or [-room]
    best = total = own[0]
    for r, s in enumerate(own[1:], 2):
        if s < -math.log(EXPECTED):
            break
        total += s
        best = max(best, total - (r - 1) * math.log(2 * total) + math.lgamma(r + 1) + math.lgamma(r))
    return best


def best_segment(spark: SparkSession, model: dict):
    """Pandas UDF: text to (n_words, top score, significant passages ``first:end``, evidence)."""
    held = spark.sparkContext.broadcast((model["scores"], model["lam"], model["k"]))   # one array of BUCKETS

    @F.pandas_udf("n_words long, top double, passages string, evidence double")
    def run(texts: pd.Series) -> pd.DataFrame:
        scores, lam, k = held.value
        out = []
        for text in texts:
            at = buckets_of(text)
            found = segments(scores[at]) if len(at) else []
            clear = [f"{a}:{b}" for s, a, b in found if k * len(at) * math.exp(-lam * s) <= EXPECTED]
            out.append((len(at), max((s for s, _, _ in found), default=0.0), ",".join(clear), evidence([s for s, _, _ in found], len(at), lam, k)))
        return pd.DataFrame(out, columns=["n_words", "top", "passages", "evidence"])
    return run


def with_score(docs: DataFrame, model: dict, prefix: str = "tox") -> DataFrame:
    """``docs`` with a struct column ``prefix``: n_words, top, passages, evidence, score."""
    found = best_segment(docs.sparkSession, model)(F.col("text"))
    docs = docs.withColumn(prefix, found)
    if model["b"] == 0.0:
        score = F.lit(model["share"])
    else:
        score = 1 / (1 + F.exp(-(model["a"] + model["b"] * F.col(f"{prefix}.evidence"))))
    return docs.withColumn(prefix, F.col(prefix).withField("score", score.cast("double")))


def op6_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(long_id().alias("doc_id"), "text")
    scored = with_score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("tox.score").alias("score"),
                         (F.col("tox.score") >= 0.5).cast("int").alias("predicted"), F.col("tox.passages").alias("passages"))

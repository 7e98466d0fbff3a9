"""Operator 9: substring dedup by fixed-block anchors.

A repeat is a run of ``WINDOW`` words whose sequence also starts earlier (smaller id, or same id and earlier
start); every word of such a run is removed. As WINDOW >= 2 * BLOCK - 1, each window holds one whole block of
the grid that cuts its document every ``BLOCK`` words. So a repeated sequence has a grid block, in the place
that comes first, which occurs at some offset in the other place.

1. Index and probe. Every document gives its grid blocks and its rolling windows of BLOCK words, as hashes. They
   meet by hash; a hash is live if it is a grid block and occurs at least twice anywhere.
2. Extend. Around live hashes, and only there, the windows of WINDOW words are keyed by 128 bits. They meet by
   key, and each bucket of documents learns which of its keys start earlier elsewhere.
3. Remove. Such windows, and later ones of the same key in the bucket itself, cover the words that go;
   overlapping windows join into maximal repeats.

Keys. Each distinct word has two independent 64-bit hashes (128 bits of its bytes), and each half of a window's key is a
polynomial of one of them. Two windows that differ in a word share a key with probability 2^-128, whatever the words hold
in common: about 1e-12 for any pair among the 2e13 windows of 100 TB.

Documents are dealt into buckets by hash, as compressed texts, once; ``checkpoint()`` keeps that dealing, so
later steps bring only the small replies to the texts. A bucket sends each distinct hash or key once, with the
first place it has, however often copies repeat it: a passage that a third of all documents share costs one
entry per bucket, and no pairs are ever made. Hashes travel as sorted, delta-coded byte planes.

Defined results: NULL and empty texts have no words, nothing removed, the digest of nothing; NULL ids come
after all others; rows that share an id count as one document (a window at the same start is not earlier);
texts shorter than WINDOW keep all words; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm.common import dealt_once, long_id, read_table
from lakeload.llm.wordhash import BASES, U, compressed, rolling, texts_of, valid_starts, word_keys

WINDOW, BLOCK = 20, 10
BUCKET_BYTES = 8 << 20     # text of a bucket; their number follows the data


def pack(values: np.ndarray) -> bytes:
    """Sorted uint32 values as byte planes of their differences (the upper planes are nearly constant)."""
    return np.diff(values, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(body: bytes) -> np.ndarray:
    planes = np.frombuffer(body, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def home_of(hashes: np.ndarray, homes: int) -> np.ndarray:
    """Meeting place of a hash, from its upper half; its lower half stands for it there."""
    return (((hashes >> U(32)) * U(homes)) >> U(32)).astype(np.int64)


def slices(sorted_homes: np.ndarray) -> Iterator[tuple[int, slice]]:
    cuts = np.flatnonzero(np.diff(sorted_homes)) + 1
    for a, b in zip(np.concatenate(([0], cuts)).tolist(), np.concatenate((cuts, [len(sorted_homes)])).tolist()):
        if b > a:
            yield int(sorted_homes[a]), slice(a, b)


def probe(homes: int, block: int):
    """Bucket of texts -> per home its distinct rolling hashes, whether they are grid blocks, whether twice here."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        words, _, bounds = word_keys(texts_of(pdf))
        starts = valid_starts(bounds, block)
        found = rolling(words, block, BASES[1])[starts] if len(starts) else np.zeros(0, U)
        on_grid = (starts - np.repeat(bounds[:-1], np.maximum(0, np.diff(bounds) - block + 1))) % block == 0
        # home, then lower half, in one sortable value; the lowest bit says "not on the grid"
        coded = (home_of(found, homes).astype(U) << U(33)) | ((found & U(0xFFFFFFFF)) << U(1)) | (~on_grid).astype(U)
        coded.sort()
        value = coded >> U(1)
        head = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1]))) if len(value) else np.zeros(0, int)
        twice = np.diff(np.concatenate((head, [len(value)]))) > 1
        grid = (coded[head] & U(1)) == 0
        value = value[head]
        rows = [(h, int(pdf["bucket"].iloc[0]), pack((value[s] & U(0xFFFFFFFF)).astype(np.uint32)),
                 np.packbits(grid[s]).tobytes(), np.packbits(twice[s]).tobytes()) for h, s in slices(value >> U(32))]
        return pd.DataFrame(rows, columns=["home", "bucket", "hashes", "grid", "twice"])
    return run


def meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """One home: the live hashes among those that each bucket sent."""
    values = [unpack(b) for b in pdf["hashes"]]
    bits = lambda c: [np.unpackbits(np.frombuffer(b, np.uint8), count=len(v)).astype(bool) for b, v in zip(pdf[c], values)]
    every, which = np.unique(np.concatenate(values), return_inverse=True)
    times = np.bincount(which, weights=1 + np.concatenate(bits("twice")))
    grid = np.zeros(len(every), bool)
    grid[which[np.concatenate(bits("grid"))]] = True
    live = ((times > 1) & grid)[which]
    rows, at = [], 0
    for bucket, home, v in zip(pdf["bucket"], pdf["home"], values):
        own = v[live[at:at + len(v)]]
        at += len(v)
        if len(own):
            rows.append((bucket, home, pack(own)))
    return pd.DataFrame(rows, columns=["bucket", "home", "hashes"])


def window_keys(words: np.ndarray, others: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the windows from ``starts``, each half from its own word hashes."""
    return rolling(words, window, BASES[1])[starts], rolling(others, window, BASES[2])[starts]


def by_key(first, second, doc, start) -> tuple[np.ndarray, np.ndarray]:
    """Order by key, then place; and for each entry of that order where its key's run begins."""
    order = np.lexsort((start, doc, second, first))
    a, b = first[order], second[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[:len(order)]
    begin = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else order
    return order, begin


KEY = np.dtype([("first", "<u8"), ("second", "<u8"), ("doc", "<i8"), ("start", "<u4")])
LOST = np.dtype([("first", "<u8"), ("second", "<u8")])


def extend(homes: int, window: int, block: int):
    """Bucket of texts and its live hashes -> per home the bucket's distinct window keys around them, first places."""
    def run(key, pdf: pd.DataFrame, live: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(pdf) and len(live):
            words, others, bounds = word_keys(texts_of(pdf))
            here = np.sort(np.concatenate([(U(h) << U(32)) | unpack(b).astype(U) for h, b in zip(live["home"], live["hashes"])]))
            small = rolling(words, block, BASES[1])
            coded = (home_of(small, homes).astype(U) << U(32)) | (small & U(0xFFFFFFFF))
            hit = np.zeros(len(words) + 1, np.int64)
            hit[1:len(small) + 1] = here[np.minimum(np.searchsorted(here, coded), len(here) - 1)] == coded
            hits = np.cumsum(hit)
            starts = valid_starts(bounds, window)
            starts = starts[hits[starts + window - block + 1] > hits[starts]]
            if len(starts):
                doc_at = np.searchsorted(bounds, starts, side="right") - 1
                first, second = window_keys(words, others, starts, window)
                doc, start = pdf["ord"].to_numpy()[doc_at], starts - bounds[doc_at]
                order, begin = by_key(first, second, doc, start)
                order = order[begin == np.arange(len(order))]
                out = np.empty(len(order), KEY)
                out["first"], out["second"], out["doc"], out["start"] = first[order], second[order], doc[order], start[order]
                rows = [(h, int(key[0]), out[s].tobytes()) for h, s in slices(home_of(out["first"], homes))]
        return pd.DataFrame(rows, columns=["home", "bucket", "keys"])
    return run


def decide(pdf: pd.DataFrame) -> pd.DataFrame:
    """One home: for each bucket the keys that start earlier in another one."""
    sent = [np.frombuffer(b, KEY) for b in pdf["keys"]]
    every = np.concatenate(sent)
    order, begin = by_key(every["first"], every["second"], every["doc"], every["start"])
    ahead = every[order[begin]]
    own = every[order]
    lost = np.zeros(len(every), bool)
    lost[order] = (ahead["doc"] < own["doc"]) | ((ahead["doc"] == own["doc"]) & (ahead["start"] < own["start"]))
    rows, at = [], 0
    for bucket, keys in zip(pdf["bucket"], sent):
        mine = keys[lost[at:at + len(keys)]]
        at += len(keys)
        if len(mine):
            out = np.empty(len(mine), LOST)
            out["first"], out["second"] = mine["first"], mine["second"]
            rows.append((bucket, out.tobytes()))
    return pd.DataFrame(rows, columns=["bucket", "keys"])


def remove(window: int):
    """Bucket of texts and its lost keys -> per text the kept words and the repeats that went."""
    def run(key, pdf: pd.DataFrame, lost: pd.DataFrame) -> pd.DataFrame:
        rows = []
        texts = texts_of(pdf)
        words, others, bounds = word_keys(texts)
        starts = valid_starts(bounds, window)
        gone = np.zeros(len(words) + 1, np.int64)
        if len(starts):
            first, second = window_keys(words, others, starts, window)
            doc_at = np.searchsorted(bounds, starts, side="right") - 1
            doc, start = pdf["ord"].to_numpy()[doc_at], starts - bounds[doc_at]
            # within the bucket: only keys that occur twice need their places compared
            ranked = np.sort(first)
            again = ranked[1:][ranked[1:] == ranked[:-1]]
            bad = np.zeros(len(starts), bool)
            some = np.flatnonzero(_among(first, again))
            if len(some):
                order, begin = by_key(first[some], second[some], doc[some], start[some])
                at, ahead = some[order], some[order[begin]]
                bad[at] = (doc[ahead] < doc[at]) | ((doc[ahead] == doc[at]) & (start[ahead] < start[at]))
            if len(lost):
                keys = np.concatenate([np.frombuffer(b, LOST) for b in lost["keys"]])
                near = np.flatnonzero(_among(first, np.sort(keys["first"])))
                known = set(zip(keys["first"].tolist(), keys["second"].tolist()))
                bad[near] |= np.fromiter((k in known for k in zip(first[near].tolist(), second[near].tolist())), bool, len(near))
            np.add.at(gone, starts[bad], 1)
            np.add.at(gone, starts[bad] + window, -1)
        covered = np.cumsum(gone)[:len(words)] > 0
        for i, text in enumerate(texts):
            out = covered[bounds[i]:bounds[i + 1]]
            kept, went = text.split(), ""
            n = len(kept)
            if out.any():
                kept = list(compress(kept, (~out).tolist()))
                edge = np.flatnonzero(np.diff(np.concatenate(([False], out, [False])).astype(np.int8))).reshape(-1, 2)
                went = ",".join(f"{a}:{b}" for a, b in edge.tolist())
            rows.append((int(pdf["ord"].iloc[i]), bool(pdf["no_id"].iloc[i]), n, int(out.sum()),
                         b" ".join(kept).decode("utf-8", "surrogatepass"), went))
        return pd.DataFrame(rows, columns=["ord", "no_id", "n_words", "n_removed", "kept", "repeats"])
    return run


def _among(values: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Which values stand in the sorted array."""
    if not len(ranked):
        return np.zeros(len(values), bool)
    return ranked[np.minimum(np.searchsorted(ranked, values), len(ranked) - 1)] == values


def remove_repeats(docs: DataFrame, window: int = WINDOW, block: int = BLOCK, buckets: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, repeats) for every row of ``docs``; repeats are ``first:end`` word spans."""
    if window < 2 * block - 1:
        raise ValueError("a window must hold a whole block of the grid")
    n = buckets or max(1, -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES))
    last = (1 << 63) - 1
    rows = (docs.select(long_id().alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .select(F.coalesce("doc_id", F.lit(last)).alias("ord"), F.col("doc_id").isNull().alias("no_id"),
                    F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int").alias("bucket"),
                    compressed(F.col("text")).alias("packed")))
    dealt = dealt_once(rows, n, "bucket")
    texts = lambda: dealt.select("bucket", "ord", "no_id", "packed").groupBy("bucket")

    sent = texts().applyInPandas(probe(n, block), "home int, bucket int, hashes binary, grid binary, twice binary")
    live = sent.groupBy("home").applyInPandas(meet, "bucket int, home int, hashes binary")
    keys = texts().cogroup(live.groupBy("bucket")).applyInPandas(extend(n, window, block), "home int, bucket int, keys binary")
    lost = keys.groupBy("home").applyInPandas(decide, "bucket int, keys binary")
    out = texts().cogroup(lost.groupBy("bucket")).applyInPandas(
        remove(window), "ord long, no_id boolean, n_words long, n_removed long, kept string, repeats string")
    return out.select(F.when(~F.col("no_id"), F.col("ord")).alias("doc_id"), "n_words", "n_removed", "kept", "repeats")


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(doc_id, 9223372036854775807) AS ord,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT row, ord, i, array_to_string(w[i:i + 19], ' ') AS k FROM d, unnest(range(1, len(w) - 18)) AS t(i)),
r AS (SELECT row, i, rank() OVER (PARTITION BY k ORDER BY ord, i) AS n FROM g),
x AS (SELECT DISTINCT row, i + j AS pos FROM r, range(20) AS s(j) WHERE n > 1),
m AS (SELECT d.row, t.pos, d.w[t.pos] AS word FROM d, unnest(range(1, len(d.w) + 1)) AS t(pos)),
k AS (SELECT m.row, count(*) AS n_kept, string_agg(m.word, ' ' ORDER BY m.pos) AS kept
      FROM m LEFT JOIN x ON x.row = m.row AND x.pos = m.pos WHERE x.pos IS NULL GROUP BY m.row)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.row = d.row
"""

"""Operator 11: phrase collocations by SON partitioning.

A-Z are lower-cased, texts cut into pieces at ``[.,;:!?]`` and line ends, pieces into words at blanks and tabs. All
counts are per language (NULL: ``und``): n of all words, f(phrase) of its contiguous occurrences within pieces.
Phrases of up to ``LONGEST`` words with f >= ``SUPPORT`` are wanted, exactly. A run within a phrase has at least its count, so
words that may be frequent come first, then pairs of them, then longer phrases of frequent pairs, with the words that the pairs
hold. Each time there are three parts (of the words that may be frequent, the first two):

1. Mine. A task cuts its documents, language by language, into shards of up to ``SHARD_BYTES`` and mines each
   completely: every phrase whose runs are frequent and which reaches the local support, SUPPORT times the shard's share of
   the language's words, rounded up. As the shares sum to 1, a wanted phrase reaches it in some shard.
2. Union. Shards send these phrases with their counts, packed by ranges of a 96-bit hash. A phrase that a
   shard did not send has less than the local support there; where the counts sent and this bound for all other
   shards stay below SUPPORT together, the phrase is out. The hashes of the rest also become one Bloom filter of a fixed size
   (``FILTER_BITS``). It never misses a candidate; a false positive only costs time.
3. Count. A second pass over all texts counts what passes the filter, packed by the same ranges; each range sums its
   counts, leaves those of its candidates, and drops what is below SUPPORT.

Cutting a phrase after its first k words gives l and r, which have at least the phrase's own count and are therefore
among the counted phrases; the score is floor(1000 * a * n / (l * r)) in decimals of 38 digits, the lowest cut counts.
A phrase is dropped if a longer candidate that holds it has ``ABSORB`` percent of its count.

Memory: a task holds ``SHARD_BYTES`` of text per language, twice that in all, and the filters; a range of hashes holds
those of about ``RANGE_WORDS`` words. Nothing that grows with the data reaches the driver. Texts are not shuffled. Two phrases of
one language share 96 bits with probability 2^-96: about 1e-7 for any candidate among the 1e13 phrases of 100 TB.

Defined results: NULL and empty texts have no words; NULL and ``und`` are one language; repeated rows count each; ties go
to the larger count, then the smaller phrase in byte order; an empty table gives no rows; columns other than ``text`` and
``lang`` are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count as numbers

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeload.llm.common import read_table, stored
from lakeload.llm.wordhash import BASES, U, mix

SUPPORT, LONGEST, TOP, ABSORB = 100, 5, 2000, 100
SHARD_BYTES = 16 << 20
RANGE_WORDS = 2_000_000
FILTER_BITS = 1 << 26
PROBES = 4
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
#: Bytes of a text to words and ends of pieces: A-Z become a-z, a tab a blank, what cuts pieces a line feed.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if b == 9 else 0x0A if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


def word_ids(texts: Iterable[str | None]) -> tuple[np.ndarray, list[bytes]]:
    """A number per word, in order, -1 at the end of each piece; and the words by number."""
    ids: defaultdict = defaultdict(numbers().__next__)
    end = ids[b"\n"]
    parts = []
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).replace(b"\n", b" \n ")
        parts.append(np.fromiter(map(ids.__getitem__, filter(None, raw.split(b" "))), np.int32))
        parts.append(np.full(1, end, np.int32))
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)) - 1, list(ids)[1:]


KEY = np.dtype([("hash", "<u8"), ("more", "<u4")])
SENT = np.dtype([("hash", "<u8"), ("more", "<u4"), ("n", "<u4")])


def levels(words: np.ndarray, names: list[bytes], seed: int, longest: int, keep: Callable) -> Iterator[tuple]:
    """(k, first, last, counts, keys) of the phrases of k = 1, 2, ... words that ``keep(k, hashes, counts)`` lets go on.

    ``last`` is the number of a phrase's last word, ``first`` the place of what stands before it in the level below.
    """
    both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(w, seed) for w in names), "<u8").reshape(-1, 2).astype(U)
    hash_of, more_of = both[:, 0], both[:, 1]
    counts = np.bincount(words[words >= 0], minlength=len(names)) if len(names) else np.zeros(0, np.int64)
    good = keep(1, hash_of, counts)
    place = np.append(np.where(good, np.cumsum(good) - 1, -1), -1).astype(np.int32)
    at, last = place[words], np.flatnonzero(good)
    first, hashes, more, counts = np.zeros(len(last), np.int64), hash_of[good], more_of[good], counts[good]
    for k in range(2, longest + 2):
        if not len(last):
            return
        keys = np.empty(len(last), KEY)
        keys["hash"], keys["more"] = hashes, more & U(0xFFFFFFFF)
        yield k - 1, first, last, counts, keys
        if k > longest:
            return
        a, b = at[:-1], at[1:]
        pairs = np.flatnonzero((a >= 0) & (b >= 0))
        found, inverse, counts = np.unique(a[pairs].astype(np.int64) * (len(last) + 1) + b[pairs], return_inverse=True, return_counts=True)
        first, behind = found // (len(last) + 1), found % (len(last) + 1)
        hashes = mix(hashes[first] * U(BASES[1]) + hash_of[last[behind]])
        more = mix(more[first] * U(BASES[2]) + more_of[last[behind]])
        good = keep(k, hashes, counts)
        at = np.full(len(a), -1, np.int32)
        at[pairs] = np.where(good, np.cumsum(good) - 1, -1)[inverse]
        first, last, hashes, more, counts = first[good], last[behind[good]], hashes[good], more[good], counts[good]


def seed_of(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))


def local_support(support: int, words: int, everywhere: int) -> int:
    return max(1, -(-support * words // everywhere))


def shards(batches: Iterator[pd.DataFrame], most: int) -> Iterator[tuple[str, int, list]]:
    """(lang, n, texts): a task's documents, language by language, in runs of about ``most`` bytes at most."""
    held: dict[str, tuple[int, list]] = {}
    size: dict[str, int] = {}
    for pdf in batches:
        for lang, n, text in zip(pdf["lang"], pdf["n"], pdf["text"]):
            held.setdefault(lang, (n, []))[1].append(text)
            size[lang] = size.get(lang, 0) + len(text)
            if size[lang] >= most:
                del size[lang]
                yield lang, *held.pop(lang)
        while sum(size.values()) > 2 * most:
            largest = max(size, key=size.get)
            del size[largest]
            yield largest, *held.pop(largest)
    for lang, (n, texts) in held.items():
        yield lang, n, texts


class Filter:
    """Bloom filter of 64-bit hashes."""

    def __init__(self, body: bytes):
        self.table = np.frombuffer(body, U)

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
        second = mix(hashes) | U(1)
        for i in range(PROBES):
            yield mix(hashes + U(i) * second) & U(bits - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        ok = np.ones(len(hashes), bool)
        for at in self.places(hashes, 64 * len(self.table)):
            ok &= (self.table[at >> U(6)] >> (at & U(63))) & U(1) == 1
        return ok


def filter_of(found: DataFrame, bits: int) -> bytes:
    """Filter of all hashes in the packed ``keys``; its size is ``bits`` whatever their number."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            hashes = np.frombuffer(b"".join(pdf["keys"]), KEY)["hash"]
            at = np.unique(np.concatenate([*Filter.places(hashes, bits)]))
            yield pd.DataFrame({"word": (at >> U(6)).astype(np.int64), "bit": (U(1) << (at & U(63))).view(np.int64)})
    words = found.select("keys").mapInPandas(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, U)
    out[words["word"].to_numpy()] = words["bit"].to_numpy().view(U)
    return out.tobytes()


def by_range(keys: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """Ranges of sorted keys that hold any, and where."""
    edges = np.searchsorted(((keys["hash"] >> U(32)) * U(ranges)) >> U(32), np.arange(ranges + 1))
    for i in np.flatnonzero(np.diff(edges)).tolist():
        yield i, slice(edges[i], edges[i + 1])


def packed(levels_: list[tuple], over: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(counts less ``over``, by key; the order that brings all phrases of the levels there)."""
    out = np.empty(sum(len(x[4]) for x in levels_), SENT)
    if len(out):
        keys = np.concatenate([x[4] for x in levels_])
        out["hash"], out["more"], out["n"] = keys["hash"], keys["more"], np.concatenate([x[3] for x in levels_]) - over
    order = np.lexsort((out["more"], out["hash"]))
    return out[order], order


def spelled(names: list[bytes], found: list[tuple]) -> list[list[bytes]]:
    """The phrases of each level, words joined by a blank."""
    out: list[list[bytes]] = []
    for k, first, last, *_ in found:
        ends = [names[i] for i in last.tolist()]
        out.append([out[-1][i] + b" " + w for i, w in zip(first.tolist(), ends)] if k > 1 else ends)
    return out


def mine(known, low: int, high: int, support: int, ranges: int, most: int, named: bool = True):
    """Texts -> (lang, range, silent, sent, names): a shard's locally frequent phrases by ranges of hashes, with their counts
    over what a shard that is silent may hold; a row of range -1 for each shard says how much that is (``silent``)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent = Filter(known.value)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for lang, n, texts in shards(batches, most):
            words, names = word_ids(texts)
            least = local_support(support, int((words >= 0).sum()), n)
            keep = lambda k, hashes, counts: frequent.has(hashes) if k < low else counts >= least  # noqa: B023, E731
            found = list(levels(words, names, seed_of(lang), high, keep))
            out, order = packed([x for x in found if x[0] >= low], least - 1)
            phrases = [p for x, own in zip(found, spelled(names, found) if named else ()) if x[0] >= low for p in own]
            phrases = [phrases[i] for i in order.tolist()] if named else []
            rows = [(lang, i, 0, out[s].tobytes(), squeeze(b"\n".join(phrases[s])) if named else b"") for i, s in by_range(out, ranges)]
            yield pd.DataFrame([(lang, -1, least - 1, b"", b""), *rows], columns=["lang", "range", "silent", "sent", "names"])
    return run


def possible(support: int):
    """One language's range of hashes -> the phrases whose counts may reach the support."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sent = np.frombuffer(b"".join(pdf["sent"]), SENT)
        keys, at, which = np.unique(sent[["hash", "more"]], return_index=True, return_inverse=True)
        some = np.bincount(which, weights=sent["n"], minlength=len(keys)) >= support - int(pdf["everywhere"].iloc[0])
        undo = zstandard.ZstdDecompressor().decompress
        names = [p for z in pdf["names"] if z for p in undo(z).split(b"\n")]
        left = np.ascontiguousarray(keys[some].astype(KEY)).tobytes()
        blob = zstandard.ZstdCompressor(level=1).compress(b"\n".join([names[i] for i in at[some].tolist()])) if names else b""
        return pd.DataFrame([(pdf["lang"].iloc[0], int(pdf["range"].iloc[0]), left, blob)] * bool(some.any()), columns=["lang", "range", "keys", "names"])
    return run


def count(known, wanted, low: int, high: int, ranges: int, most: int, words_too: bool):
    """Texts -> (lang, range, sent): counts of the phrases of ``low`` to ``high`` words that pass, and of words, in parts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent, candidate = Filter(known.value), Filter(wanted.value)
        keep = lambda k, hashes, _: (frequent if k < low else candidate).has(hashes)
        for lang, _, texts in shards(batches, most):
            words, names = word_ids(texts)
            out, _ = packed([x for x in levels(words, names, seed_of(lang), high, keep) if x[0] >= low or words_too and x[0] == 1])
            if len(out):
                yield pd.DataFrame([(lang, i, out[s].tobytes()) for i, s in by_range(out, ranges)], columns=["lang", "range", "sent"])
    return run


def total(support: int):
    """One language's range: its candidates and all counts -> the frequent phrases."""
    def run(key, left: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"lang": pd.Series(dtype=object), "k": pd.Series(dtype=np.int32), "phrase": pd.Series(dtype=object),
                             "key": pd.Series(dtype=object), "f": pd.Series(dtype=np.int64)})
        if not len(left) or not len(parts):
            return none
        sent = np.frombuffer(b"".join(parts["sent"]), SENT)
        keys, which = np.unique(sent[["hash", "more"]], return_inverse=True)
        f = np.bincount(which, weights=sent["n"], minlength=len(keys)).astype(np.int64)
        wanted = np.frombuffer(b"".join(left["keys"]), KEY)
        names = [p for z in left["names"] for p in zstandard.ZstdDecompressor().decompress(z).split(b"\n")]
        at = np.searchsorted(keys, wanted.astype(keys.dtype))       # every candidate was counted somewhere
        enough = np.flatnonzero(f[at] >= support).tolist()
        if not enough:
            return none
        phrases = [names[i] for i in enough]
        return pd.DataFrame({"lang": key[0], "k": [p.count(b" ") + 1 for p in phrases], "phrase": [p.decode("utf-8", "surrogatepass") for p in phrases],
                             "key": [wanted[i:i + 1].tobytes() for i in enough], "f": f[at][enough]})
    return run


def words_of_phrases(phrases: DataFrame, ranges: int) -> DataFrame:
    """(lang, range, keys, names): the words that the phrases hold, packed like candidates."""
    words = phrases.select("lang", F.explode(F.split("phrase", " ")).alias("word")).distinct()

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for lang, word in zip(pdf["lang"], pdf["word"]):
                name = word.encode("utf-8", "surrogatepass")
                found = next(levels(np.zeros(1, np.int32), [name], seed_of(lang), 1, lambda k, h, c: c > 0))
                (at, _), = by_range(found[4], ranges)
                rows.append((lang, at, found[4].tobytes(), zstandard.ZstdCompressor(level=1).compress(name)))
            yield pd.DataFrame(rows, columns=["lang", "range", "keys", "names"])
    return words.mapInPandas(keyed, "lang string, range int, keys binary, names binary")


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, shard_bytes: int = SHARD_BYTES,
                     range_words: int = RANGE_WORDS, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, k, phrase, key, f) of every phrase of two words or more with f >= support, and of their words; (lang, n)), stored."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    totals = rows.groupBy("lang").agg(F.sum(F.regexp_count("text", F.lit(WORD))).cast("long").alias("n"))
    totals = stored(totals.where("n > 0"), "phrase_totals")
    ranges = max(1, -(-(totals.agg(F.sum("n")).first()[0] or 0) // range_words))
    texts = rows.join(totals, "lang")

    def filtered(keys: DataFrame):
        return spark.sparkContext.broadcast(filter_of(keys.select("keys"), bits))

    def candidates(known, low: int, high: int, named: bool = True) -> DataFrame:
        found = texts.mapInPandas(mine(known, low, high, support, ranges, shard_bytes, named),
                                  "lang string, range int, silent long, sent binary, names binary")
        found = stored(found, "phrase_mined")
        silent = found.where("range < 0").groupBy("lang").agg(F.sum("silent").alias("everywhere"))
        left = found.where("range >= 0").join(silent, "lang").groupBy("lang", "range")
        return stored(left.applyInPandas(possible(support), "lang string, range int, keys binary, names binary"), "phrase_candidates")

    def counted(left: DataFrame, known, wanted, low: int, high: int, words_too: bool = False) -> DataFrame:
        parts = texts.mapInPandas(count(known, wanted, low, high, ranges, shard_bytes, words_too), "lang string, range int, sent binary")
        counts = left.groupBy("lang", "range").cogroup(parts.groupBy("lang", "range")).applyInPandas(
            total(support), "lang string, k int, phrase string, key binary, f long")
        return stored(counts, "phrase_counts")

    nothing = spark.sparkContext.broadcast(bytes(bits // 8))
    maybe = filtered(candidates(nothing, 1, 1, named=False))
    left = candidates(maybe, 2, min(2, longest))
    pairs = counted(left, maybe, filtered(left), 2, 2)
    words = stored(words_of_phrases(pairs, ranges), "phrase_words")
    known = filtered(words.select("keys").union(pairs.select("key")))
    left = candidates(known, 3, longest) if longest > 2 else left.limit(0)
    longer = counted(left.unionByName(words), known, filtered(left) if longest > 2 else nothing, 3, max(2, longest), words_too=True)
    return pairs.unionByName(longer), totals


def score_of(a: str, n: str, l: str, r: str):  # noqa: E741
    """floor(1000 * a * n / (l * r)); factors of 18 and 19 digits have a product of at most 38, so nothing is rounded."""
    wide = lambda c, digits: f"cast({c} as decimal({digits},0))"
    return F.expr(f"({wide(f'1000 * {a}', 18)} * {wide(n, 19)}) div ({wide(l, 18)} * {wide(r, 19)})")


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP, absorb: int = ABSORB, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two words or more."""
    counts, totals = frequent_phrases(docs, support, longest, **options)
    candidates = counts.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    joined = lambda start, n: F.array_join(F.slice("w", start, n), " ")

    cut = F.col("cut")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", joined(F.lit(1), cut).alias("first"), joined(cut + 1, F.col("k") - cut).alias("rest"))
    part = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    lowest = cuts.withColumn("score", score_of("a", "n", "l", "r")).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("c"))

    # runs of at least two words within a longer candidate, and the largest count of one that holds them
    inside = candidates.where("k > 2").select("lang", "a", "k", "w", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("m"))
    inside = inside.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("m") + 1)).alias("at"))
    inside = inside.groupBy("lang", joined(F.col("at"), F.col("m")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = lowest.join(inside, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < absorb * F.col("a"), F.lit(True)))

    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score").withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM w, range(1, 6) AS t(k), unnest(range(1, len(w) - k + 2)) AS s(i)),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
s AS (SELECT c.lang, c.phrase, c.a, n.n, x.f AS l, y.f AS r, cut, ((1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
      FROM c, unnest(range(1, c.k)) AS t(cut)
      JOIN n ON n.lang = c.lang
      JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
      JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM s),
i AS (SELECT DISTINCT c.lang, array_to_string(c.w[pos:pos + m - 1], ' ') AS phrase, c.a
      FROM c, range(2, 5) AS t(m), unnest(range(1, c.k - m + 2)) AS u(pos) WHERE m < c.k),
k AS (SELECT b.* FROM b WHERE o = 1 AND NOT EXISTS (SELECT 1 FROM i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.a >= 100 * b.a)),
z AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score FROM k)
SELECT * FROM z WHERE rank <= 2000
"""

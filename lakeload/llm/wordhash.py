"""Hashes of words and of runs of words, for many texts at once, and compressed texts for shuffles.

A word is a run of bytes other than 0x20 and 0x09 to 0x0D. Everything is exact modular arithmetic on 64 bits,
so that every task, and every rerun, gets the same values.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import functions as F

CHUNK = 1 << 20                     # bytes of text that are hashed at once
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA24BAED4963EE407)   # odd multipliers: bytes, first and second key


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all others."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    return np.concatenate((np.ones(1, U), np.full(max(0, n - 1), base, U).cumprod()))[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of all texts, and where each text's words start (one more entry at the end)."""
    letter = mix(np.arange(1, 257, dtype=U) * U(BASES[0]))
    hashes, counts, at = [], [], 0
    while at < len(texts):
        size, to = 0, at
        while to < len(texts) and (to == at or size + len(texts[to]) <= CHUNK):
            size += len(texts[to]) + 1
            to += 1
        raw = np.frombuffer(b" ".join(texts[at:to]) + b" ", np.uint8)
        lengths = np.array([len(t) + 1 for t in texts[at:to]])
        blank = BLANK[raw]
        first = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
        behind = np.concatenate((np.cumsum(lengths)[:-1], [len(raw)]))
        counts.append(np.diff(np.searchsorted(first, np.concatenate(([0], behind)))))
        if len(first):
            inside = np.flatnonzero(~blank)
            ends = np.flatnonzero(blank & np.concatenate(([False], ~blank[:-1])))
            size_of = ends - first
            starts = np.concatenate(([0], np.cumsum(size_of)))[:-1]
            place = np.arange(len(inside)) - np.repeat(starts, size_of)
            value = letter[raw[inside]] * powers(BASES[0], int(size_of.max()))[place]
            hashes.append(mix(np.add.reduceat(value, starts) + size_of.astype(U)))
        at = to
    counts = np.concatenate(counts) if counts else np.zeros(0, int)
    return np.concatenate(hashes) if hashes else np.zeros(0, U), np.concatenate(([0], np.cumsum(counts))).astype(np.int64)


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every word of all texts, from 128 bits of each distinct word; and the bounds."""
    numbers: defaultdict = defaultdict(count().__next__)
    own = [np.fromiter(map(numbers.__getitem__, t.split()), np.int32) for t in texts]
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, numbers)), "<u8").reshape(-1, 2).astype(U)
    at = np.concatenate(own) if own else np.zeros(0, np.int32)
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in own]))).astype(np.int64)
    return both[at, 0], both[at, 1], bounds


def rolling(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of the ``width`` words from each start on (also across texts; callers pick valid starts)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    inverse = pow(base, -1, 1 << 64)
    total = np.concatenate((np.zeros(1, U), np.cumsum(words * powers(base, len(words)), dtype=U)))
    return mix((total[width:] - total[:n]) * powers(inverse, n))


def valid_starts(bounds: np.ndarray, width: int) -> np.ndarray:
    """Starts of windows that stay within one text."""
    room = np.maximum(0, np.diff(bounds) - width + 1)
    ahead = np.concatenate(([0], np.cumsum(room)))[:-1]
    return np.arange(room.sum()) - np.repeat(ahead, room) + np.repeat(bounds[:-1], room)


def texts_of(pdf: pd.DataFrame) -> list[bytes]:
    undo = zstandard.ZstdDecompressor()
    return [undo.decompress(z) for z in pdf["packed"]]


def compressed(text):
    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        do = zstandard.ZstdCompressor(level=1)
        return texts.map(lambda t: do.compress(t.encode("utf-8", "surrogatepass")))
    return run(text)

"""Operator 10: byte-level BPE encoding and decoding over a minimal acyclic transducer.

Lexicon. The most frequent words of the whole corpus (letters, with the blank before them) are encoded once
and compiled, in byte order, into a minimal acyclic automaton: words share prefixes and suffixes, and the
outputs along a word's path add up to its number, which leads to its ids. The automaton is four flat arrays
in one file in the shared scratch folder; Spark hands the file to every executor, where workers map it into
memory. Its size is bounded by ``LEXICON`` words of at most ``LONGEST`` bytes.

Encoding. A text is cut at special tokens, then by the tokenizer's pattern. A word found in the transducer
takes its ids; any other is merged exactly, lowest rank first and leftmost among equals, with a heap, so that
very long words stay near-linear. Workers remember a bounded number of recent words. Decoding joins the
tokens' bytes and reads them as UTF-8, replacing what is invalid.

The tokenizer's file is a parameter; nothing of it is kept in the package.

Defined results: a NULL or empty text has no ids and decodes to an empty text; special tokens in a text become
their ids; repeated rows and NULL ids are rows like any other; an empty table gives no rows; other columns are
ignored (or kept, by ``with_ids``).
"""

from __future__ import annotations

import heapq
import json
import mmap
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm.common import long_id, read_table, stored
from lakeload.session import hadoop_fs, scratch_dir

LEXICON = 1 << 16
LONGEST = 32
REMEMBER = 400_000
# Fixed value: the pattern that byte-level BPE tokenizers cut texts with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


MOST_IDS = 1 << 17     # an id shares an integer with its merge's rank


def unsupported(spec: dict) -> list[str]:
    """What a tokenizer file asks for that this operator does not do."""
    model, before, decoder = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
    plain = {"type": "BPE", "dropout": (None, 0), "unk_token": None, "continuing_subword_prefix": (None, ""), "end_of_word_suffix": (None, ""),
             "byte_fallback": (None, False), "ignore_merges": (None, False)}
    wrong = [f"model.{k}" for k, v in plain.items() if model.get(k) not in (v if isinstance(v, tuple) else (v,))]
    wrong += ["normalizer"] * bool(spec.get("normalizer"))
    wrong += ["pre_tokenizer"] * (before.get("type") != "ByteLevel" or before.get("add_prefix_space", True) or not before.get("use_regex", True))
    wrong += ["decoder"] * (decoder.get("type") != "ByteLevel")
    added = spec.get("added_tokens", [])
    wrong += [f"added token {t['content']}" for t in added if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]
    return wrong + ["ids beyond 2^17"] * (max([*model["vocab"].values(), *(t["id"] for t in added)], default=0) >= MOST_IDS)


def read_tokenizer(path: str) -> dict:
    """Plain data of a byte-level BPE file: token bytes by id, merges by pair of ids, special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if wrong := unsupported(spec):
        raise ValueError(f"{path}: not a plain byte-level BPE: {', '.join(wrong)}")
    alphabet = byte_alphabet()
    vocab = spec["model"]["vocab"]
    raw = {t: bytes(alphabet[c] for c in t) for t in vocab}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    tokens = {i: raw[t] for t, i in vocab.items()} | {i: t.encode() for t, i in special.items()}
    return {"tokens": [tokens.get(i, b"") for i in range(max(tokens) + 1)],
            "bytes": [vocab[c] for c in sorted(alphabet, key=alphabet.get)],
            "merges": {(vocab[a], vocab[b]): rank + 1 << 17 | vocab[a + b] for rank, (a, b) in enumerate(pairs)},
            "special": special}


NO_PAIR = 1 << 60
SHORT = 64            # bytes up to which a plain list of neighbouring pairs beats a heap


def merge_word(word: bytes, tok: dict) -> list[int]:
    """Ids of one pre-token: merge the lowest-ranked neighbouring pair, leftmost first, until none is left.

    ``merges`` gives rank << 17 | new id, so that the smallest value is the lowest rank.
    """
    if len(word) > SHORT:
        return _merge_long(word, tok)
    pair, by_byte = tok["merges"].get, tok["bytes"]
    ids = [by_byte[b] for b in word]
    values = [pair(p, NO_PAIR) for p in zip(ids, ids[1:])]
    while values:
        best = min(values)
        if best == NO_PAIR:
            break
        i = values.index(best)
        ids[i:i + 2] = [best & 0x1FFFF]
        del values[i]
        if i < len(values):
            values[i] = pair((ids[i], ids[i + 1]), NO_PAIR)
        if i:
            values[i - 1] = pair((ids[i - 1], ids[i]), NO_PAIR)
    return ids


def _merge_long(word: bytes, tok: dict) -> list[int]:
    """The same with a heap of pairs and a linked list of pieces, near-linear in the length."""
    pair = tok["merges"].get
    ids = [tok["bytes"][b] for b in word]
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := pair((ids[i], ids[i + 1])))]
    heapq.heapify(heap)
    while heap:
        best, i, left, right = heapq.heappop(heap)
        j = after[i]
        if ids[i] != left or j >= n or ids[j] != right:
            continue                                   # one of the two has merged meanwhile
        new = best & 0x1FFFF
        ids[i], ids[j], after[i] = new, -1, after[j]
        if after[j] < n:
            before[after[j]] = i
            if m := pair((new, ids[after[j]])):
                heapq.heappush(heap, (m, i, new, ids[after[j]]))
        if before[i] >= 0 and (m := pair((ids[before[i]], new))):
            heapq.heappush(heap, (m, before[i], ids[before[i]], new))
    return [x for x in ids if x >= 0]


class Transducer:
    """Minimal acyclic automaton of sorted words; the outputs on a word's path add up to its number.

    Arrays: ``first`` (arcs of state s are first[s]..first[s+1]), ``final`` per state, and per arc its
    ``label`` byte, ``target`` state and ``out`` (words that come before the arc's in its state).
    """

    def __init__(self, first, final, label, target, out, offsets, ids):
        self.first, self.final, self.label, self.target, self.out, self.offsets, self.ids = first, final, label, target, out, offsets, ids

    @classmethod
    def build(cls, words: list[bytes], ids: list[list[int]]) -> Transducer:
        """``words`` are distinct and in byte order."""
        register: dict[tuple, int] = {}
        states: list[tuple] = []                        # (final, ((byte, state), ...)), numbered bottom-up
        path: list[list] = [[False, []]]                # the current word's states, not yet shared

        def share(down_to: int) -> None:
            while len(path) > down_to + 1:
                final, arcs = path.pop()
                key = (final, tuple(arcs))
                if key not in register:
                    register[key] = len(states)
                    states.append(key)
                path[-1][1][-1] = (path[-1][1][-1][0], register[key])
        last = b""
        for word in words:
            common = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
            share(common)
            for b in word[common:]:
                path[-1][1].append((b, -1))
                path.append([False, []])
            path[-1][0] = True
            last = word
        share(0)
        states.append((path[0][0], tuple(path[0][1])))
        below = []                                      # words that a state accepts
        first, final, label, target, out = [0], [], bytearray(), [], []
        for is_final, arcs in states:
            seen = int(is_final)
            for b, t in arcs:
                label.append(b)
                target.append(t)
                out.append(seen)
                seen += below[t]
            below.append(seen)
            final.append(is_final)
            first.append(len(target))
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.uint32)
        flat = np.array([i for x in ids for i in x], dtype=np.uint32)
        return cls(np.array(first, np.uint32), np.array(final, np.uint8), bytes(label), np.array(target, np.uint32),
                   np.array(out, np.uint32), offsets, flat)

    def to_bytes(self) -> bytes:
        parts = [self.first.tobytes(), self.target.tobytes(), self.out.tobytes(), self.offsets.tobytes(), self.ids.tobytes(),
                 self.final.tobytes(), self.label]
        return np.array([len(p) for p in parts], np.uint64).tobytes() + b"".join(parts)

    @classmethod
    def mapped(cls, path: str) -> Transducer:
        with open(path, "rb") as f:
            held = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(held, np.uint64, 7).tolist()
        starts = np.cumsum([56, *sizes]).tolist()
        view = memoryview(held)
        first, target, out, offsets, ids = (view[at:at + size].cast("I") for at, size in zip(starts, sizes[:5]))
        self = cls(first, view[starts[5]:starts[6]], held, target, out, offsets, ids)
        self.label_at = starts[6]
        return self

    label_at = 0

    def find(self, word: bytes):
        """The word's ids, or None if the lexicon lacks it."""
        first, target, out, find, at = self.first, self.target, self.out, self.label.find, self.label_at
        state, number = len(self.final) - 1, 0
        for i in range(len(word)):
            arc = find(word[i:i + 1], at + first[state], at + first[state + 1]) - at
            if arc < 0:
                return None
            number += out[arc]
            state = target[arc]
        if not self.final[state]:
            return None
        return self.ids[self.offsets[number]:self.offsets[number + 1]]


def frequent_words(docs: DataFrame, most: int = LEXICON) -> list[str]:
    """At most ``most`` of the commonest words of all texts, each with the blank before it.

    Counts are grouped into levels of a sixteenth of an octave; the driver sees the sizes of the levels (a few
    hundred rows), and then the words of as many top levels as hold ``most`` words at most.
    """
    words = docs.select(F.explode(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(r" ?\p{L}{2,}"), F.lit(0))).alias("w"))
    counted = words.groupBy("w").count().where((F.octet_length("w") <= LONGEST) & (F.col("count") > 1))
    counted = stored(counted.select("w", F.floor(F.log2("count") * 16).cast("int").alias("level")), "bpe_words")
    left, least = most, None
    for r in counted.groupBy("level").count().orderBy(F.desc("level")).collect():
        left -= r["count"]
        if left < 0:
            break
        least = r["level"]
    if least is None:
        return []
    return [r["w"] for r in counted.where(F.col("level") >= least).select("w").collect()]


def ship_lexicon(spark: SparkSession, words: list[str], tok: dict) -> str:
    """Compile the transducer, write it to the shared scratch folder and have Spark hand it out; its file name."""
    raw = sorted({w.encode() for w in words})
    # a word of letters is a pre-token of its own only if the pattern says so
    cut = regex.compile(PATTERN)
    raw = [w for w in raw if cut.findall(w.decode()) == [w.decode()]]
    blob = Transducer.build(raw, [merge_word(w, tok) for w in raw]).to_bytes()
    name = f"lexicon-{uuid.uuid4().hex}.fst"
    path = f"{scratch_dir(spark, 'llm_lexicon')}/{name}"
    fs, jpath = hadoop_fs(spark, path)
    stream = fs.create(jpath)
    for at in range(0, len(blob), 1 << 20):
        stream.write(bytearray(blob[at:at + (1 << 20)]))
    stream.close()
    spark.sparkContext.addFile(path)
    return name


def text_encoder(tok: dict, lex: Transducer):
    """Function from a text to its ids as little-endian unsigned 32-bit integers."""
    cut = regex.compile(PATTERN).findall
    special = tok["special"]
    at_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")").split if special else None
    known: dict[str, bytes] = {}
    seen = known.get

    def ids_of(word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        got = array("I", lex.find(raw) or merge_word(raw, tok)).tobytes()
        if len(word) <= LONGEST:
            if len(known) >= REMEMBER:
                known.clear()
            known[word] = got
        return got

    def encode(text: str) -> bytes:
        return b"".join([seen(w) or ids_of(w) for w in cut(text)])

    def whole(text: str | None) -> bytes:
        text = text or ""
        if at_special is None or not any(s in text for s in special):
            return encode(text)
        return b"".join(array("I", [special[p]]).tobytes() if p in special else encode(p) for p in at_special(text))
    return whole


def decode(packed: bytes, tokens: list[bytes]) -> str:
    """Text of packed ids; bytes that are no UTF-8 become replacement characters."""
    return b"".join(map(tokens.__getitem__, memoryview(packed).cast("I").tolist())).decode("utf-8", "replace")


def with_ids(docs: DataFrame, path: str, lexicon_words: int = LEXICON) -> DataFrame:
    """``docs`` with ``ids`` (packed, of its column ``text``) and ``decoded`` (from those ids)."""
    spark = docs.sparkSession
    tok = read_tokenizer(path)
    lexicon = ship_lexicon(spark, frequent_words(docs, lexicon_words), tok)
    held = spark.sparkContext.broadcast(tok)             # one vocabulary

    @F.pandas_udf("ids binary, decoded string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = held.value
        encode = text_encoder(own, Transducer.mapped(SparkFiles.get(lexicon)))
        for texts in batches:
            ids = [encode(t) for t in texts]
            yield pd.DataFrame({"ids": ids, "decoded": [decode(i, own["tokens"]) for i in ids]})
    coded = docs.withColumn("__coded", run(F.col("text")))
    return coded.withColumn("ids", F.col("__coded.ids")).withColumn("decoded", F.col("__coded.decoded")).drop("__coded")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2(F.col("ids"), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents").select(long_id().alias("doc_id"), "text")
    return digests(with_ids(docs, public_tokenizers.path("byte_bpe_50k.json")))

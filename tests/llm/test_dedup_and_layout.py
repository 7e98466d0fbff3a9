"""Fingerprints, shards, near-duplicates, repeats, search and mixing against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeload.llm import fingerprints, mixing, near_dups, repeats, sharding, topk_search, wordhash
from lakeload.llm.common import stored
from lakeload.llm.components import components


def write_docs(spark, df, name):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/{name}"
    df.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return path


# --- operator 1

def ordered(rows):
    """Rows in the operator's order: ids descending, NULL last; equal ids by text hash (given)."""
    return sorted(rows, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.h))


def test_edited_texts_follow_the_descending_order(spark, messy, documents, nothing):
    for df, ranges in ((messy, 5), (documents, None), (messy.limit(1), 3)):
        rows = ordered(df.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect())
        want = Counter()
        for r, n in zip(rows, rows[1:] + rows[:1]):
            half = len(r.t) // 2
            want[(r.doc_id, len(r.t), r.t[:len(r.t) - half] + n.t[:half])] += 1
        got = fingerprints.edited_pairs(df, ranges).select("doc_id", "n_chars", "edited").collect()
        assert Counter(map(tuple, got)) == want
    assert fingerprints.edited_pairs(nothing).count() == 0


def test_fingerprints_of_equal_and_edited_texts(spark, documents):
    got = fingerprints.op1_syncmer_fingerprints(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    by_text = defaultdict(set)
    for r in got:
        by_text[texts[r.doc_id]].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(f) == 1 for f in by_text.values()) and len({f for s in by_text.values() for f in s}) == len(by_text)
    assert np.median([r.near_edited for r in got]) > 0.35 and np.mean([r.near_next for r in got]) < 0.05


def test_anchors_are_context_free_and_cover_every_window(spark):
    rng = np.random.default_rng(3)
    core = " ".join(f"w{i}" for i in rng.integers(0, 300, 60))
    around = [" ".join(f"v{i}" for i in rng.integers(0, 300, 40)) for _ in range(4)]
    df = spark.createDataFrame([(i, f"{a} {core} {a}") for i, a in enumerate(around)], "id int, text string")
    rows = fingerprints.with_anchors(df, "text", "a", positions="pos").collect()
    inner = [{(p - 40, h) for p, h in zip(r.pos, r.a) if 40 <= p and p + fingerprints.K <= 100} for r in rows]
    assert inner[0] and all(s == inner[0] for s in inner)
    for r in rows:
        assert max(np.diff(r.pos)) <= fingerprints.K - fingerprints.S + 1


# --- operator 2

def test_shards(spark, messy, documents, nothing):
    for df, ranges in ((messy, 5), (documents, None), (messy.limit(1), 2)):
        got = sharding.shard_by_bytes(df, ranges=ranges).collect()
        want = Counter()
        for r in df.collect():
            raw = (r.text or "").encode()
            want[(r.doc_id, len(raw) + 1, zlib.crc32(raw))] += 1
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
        order = sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text_crc32, r.size))
        total, before = sum(r.size for r in got), 0
        slots = defaultdict(list)
        for r in order:
            assert r.shard == min(7, (2 * before + r.size) * 8 // (2 * total)) or r.size in (1,)
            before += r.size
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        sizes = [sum(r.size for r in got if r.shard == s) for s in range(8)]
        assert max(sizes) - min(sizes) <= 2 * max(r.size for r in got)
        assert [r.shard for r in order] == sorted(r.shard for r in got)
    assert sharding.shard_by_bytes(nothing).count() == 0


# --- operator 4

def brute_classes(texts):
    """Class (smallest index of an equal or linked text) per text, by all pairs."""
    counts = [near_dups.runs_of((t or "").encode()) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or (counts[i] and counts[j] and near_dups.likeness(counts[i], counts[j]) >= near_dups.LIKENESS):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))]


def near_rows():
    rng = np.random.default_rng(11)
    rows = []
    for g in range(6):
        base = [f"w{i}" for i in rng.integers(0, 5000, 150)]
        for _ in range(12):
            copy = list(base)
            for at in rng.integers(0, 150, int(rng.integers(0, 7))):
                copy[at] = "edit" + str(rng.integers(0, 9999))
            rows.append(" ".join(copy))
    chain = [f"c{i}" for i in range(300)]
    rows += [" ".join(chain[i * 12:i * 12 + 150]) for i in range(12)]          # each like its neighbours only
    rows += [("the same line again\n" * n) for n in (10, 11, 40)] + ["a b c", "a b c", "a  b c", "", None]
    return rows


def test_near_classes(spark, messy, documents, nothing):
    planted = spark.createDataFrame(list(enumerate(near_rows())), "doc_id long, text string")
    for df in (planted, documents.select("doc_id", "text")):
        rows = sorted(df.collect())
        want = brute_classes([r.text for r in rows])
        got = {r.doc_id: r.class_id for r in near_dups.near_classes(df).collect()}
        assert got == {r.doc_id: rows[w].doc_id for r, w in zip(rows, want)}
    assert near_dups.near_classes(nothing).count() == 0
    got = near_dups.near_classes(messy).collect()
    assert len(got) == messy.count()
    assert {r.class_id for r in got if r.doc_id in (3, 4, 5)} >= {3}
    kept = near_dups.one_of_each(messy, near_dups.near_classes(messy))
    assert kept.dtypes == messy.dtypes and kept.count() == len({r.root for r in got})


@given(st.lists(st.tuples(st.integers(0, 8), st.integers(0, 8)), min_size=20, max_size=60), st.integers(0, 1 << 30))
@settings(max_examples=40, deadline=None)
def test_signatures_estimate_weighted_jaccard(pairs, seed):
    rng = np.random.default_rng(seed)
    runs = rng.integers(0, 1 << 63, len(pairs)).astype(np.uint64)
    a, b = np.array(pairs).T
    if not a.any() or not b.any():
        return
    exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    signs = [near_dups.signature(runs[w > 0], w[w > 0], 2048) for w in (a, b)]
    assert abs((signs[0] == signs[1]).mean() - exact) < 0.07


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 120, (70, 2))] + [(i, i + 1) for i in range(200, 240)] + [(500, i) for i in range(501, 560)]
    links = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    label = {}
    for a, b in pairs:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(200):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    own = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: label[x] for x in own}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- operator 5

def brute_top(vectors, k):
    out = []
    for q, v in vectors.items():
        if q % 50 == 0:
            scored = sorted((-sum(int(a) * int(b) for a, b in zip(v, w)), i) for i, w in vectors.items() if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [1, 1 << 40])
def test_top_k(spark, scale):
    rng = np.random.default_rng(4)
    rows = {i: [float(x) * scale for x in rng.normal(0, 1, 10)] for i in range(0, 400, 2)}
    rows |= {401: rows[4], 403: rows[4], 450: [1.0] * 3, 451: [2.0] * 3, 452: [], 500: [0.0] * 10}
    bad = [(700, None, 1), (750, [None, 1.0], 1), (800, [float("nan")] * 10, 1), (850, [float("inf")] * 10, 1), (None, [1.0] * 10, 1)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows.items()] + bad, "vec_id long, embedding array<double>, block int").repartition(3)
    if scale == 1:
        whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows.items()}
        vectors = topk_search.whole_vectors(df)
    else:       # integers beyond 2**53 stay exact
        whole = {i: [int(np.floor(256 * x)) >> 30 for x in v] for i, v in rows.items()}
        vectors = spark.createDataFrame([(n, i, len(v), v) for n, (i, v) in enumerate(whole.items())], "row long, vec_id long, dim int, v array<long>")
    for block in (3, 1 << 14):
        got = topk_search.top_k(stored(vectors, "t_vectors"), F.col("vec_id") % 50 == 0, block=block).collect()
        assert sorted(map(tuple, got)) == brute_top(whole, 5)
    assert topk_search.top_k(stored(topk_search.whole_vectors(df.where("vec_id = 1")), "t_vectors"), F.lit(True)).count() == 0


def test_equal_scores_do_not_flood_the_tasks():
    block = topk_search.Block([(0, 7, [1, 2, 3])], 8, 5)
    pdf = pd.DataFrame({"vec_id": np.arange(20_000)[::-1], "dim": 3, "v": [[1, 2, 3]] * 20_000})
    block.cutoff[0] = 14
    assert list(block.run(iter([pdf]), block.collect)["vec_id"]) == [0, 1, 2, 3, 4]
    assert len(block.run(iter([pdf, pdf]), block.gather)) == 5


def test_short_candidates_are_passed_over():
    rng = np.random.default_rng(3)
    c = rng.integers(-300, 300, (5000, 16)) * rng.integers(1, 40, (5000, 1))
    block = topk_search.Block([(i, 10 ** 6 + i, rng.integers(-300, 300, 16).tolist()) for i in range(40)], 8, 5)
    pdf = pd.DataFrame({"vec_id": np.arange(5000), "dim": 16, "v": c.tolist()})
    score = np.array([block.matrix[16] @ v for v in c]).T
    block.cutoff[:] = np.sort(score, axis=1)[:, -5]
    steps = []
    real, block.scored = block.scored, lambda *args: steps.append(len(args[0])) or real(*args)
    got = block.run(iter([pdf]), block.collect)
    assert sum(steps) < 40 * 3                                      # of 40 queries and 3 steps of candidates
    want = {(q, int(v), int(score[q, v])) for q in range(40) for v in np.lexsort((np.arange(5000), -score[q]))[:5]}
    assert set(got.itertuples(index=False, name=None)) == want


@pytest.mark.parametrize("embedding", [[2.0 ** 56], [-(2.0 ** 60), 1.0]])
def test_components_beyond_64_bits_fail(spark, embedding):
    with pytest.raises(Exception, match="passes 64 bits"):
        topk_search.whole_vectors(spark.createDataFrame([(1, embedding)], "vec_id long, embedding array<double>")).collect()


def test_scores_beyond_64_bits_fail():
    block = topk_search.Block([(0, 7, [1 << 40])], 8, 5)
    with pytest.raises(OverflowError):
        block.run(iter([pd.DataFrame({"vec_id": [1], "dim": [1], "v": [[1 << 40]]})]), block.gather)


# --- operator 7

def test_mix(spark, messy, nothing):
    rows = mixing.mix(messy, slices=4).collect()
    assert len(rows) == messy.count()
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
        assert 0 <= r.taken <= 2 * r.size
    for own in by_source.values():
        assert abs(sum(r.taken for r in own) - own[0].target) < 1 and own[0].source_size == sum(r.size for r in own)
    assert Counter(tuple(r)[1:] for r in rows) == Counter(tuple(r)[1:] for r in mixing.mix(messy, slices=9).collect())
    assert mixing.mix(nothing).count() == 0
    out = mixing.take(messy)
    assert out.dtypes == messy.dtypes
    words = {s: sum(len((r.text or "").encode().split()) for r in out.where(F.col("source").eqNullSafe(s)).collect()) for s in by_source}
    assert words == {s: sum(r.taken for r in own) for s, own in by_source.items()}


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
@settings(max_examples=25, deadline=None)
def test_targets_equal_repeated_resharing(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    target, open_, left = [0.0] * len(sizes), set(range(len(sizes))), 1.5 * sum(sizes)
    while open_:
        share = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if share * weights[i] > 2 * sizes[i]]
        if not full:
            for i in open_:
                target[i] = share * weights[i]
            break
        for i in full:
            target[i] = 2.0 * sizes[i]
            left -= target[i]
            open_.discard(i)
    assert all(abs(got[f"s{i}"] - t) < 1e-6 * max(1.0, t) for i, t in enumerate(target))


# --- operator 9

def brute_repeats(rows, window=20):
    """(doc_id, n_words, n_removed, sha256) per row; rows with one id are one document."""
    first, words = {}, [((1 << 63) - 1 if i is None else i, i, [w for w in _blank_split(t)]) for i, t in rows]
    for d, _, w in words:
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            first[k] = min(first.get(k, (d, s)), (d, s))
    out = Counter()
    for d, i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < (d, s):
                gone.update(range(s, s + window))
        kept = " ".join(x for at, x in enumerate(w) if at not in gone)
        out[(i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def _blank_split(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_repeats(spark, messy, nothing):
    rng = np.random.default_rng(9)
    passage = [f"p{i}" for i in range(60)]
    rows = [(int(i), " ".join([f"u{x}" for x in rng.integers(0, 10**6, rng.integers(0, 50))] + passage[a:a + n] + [f"u{x}" for x in rng.integers(0, 10**6, 9)]))
            for i, (a, n) in enumerate(zip(rng.integers(0, 40, 60), rng.integers(15, 60, 60)))]
    rows += [(90, "same word " * 200), (91, " ".join(passage * 3)), (92, " ".join(passage)), (92, " ".join(passage[5:] + ["tail"] * 3))]
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    for df in (planted, messy):
        got = Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest())
                      for r in repeats.remove_repeats(df, buckets=7).collect())
        assert got == brute_repeats([tuple(r) for r in df.select("doc_id", "text").collect()])
    assert repeats.remove_repeats(nothing).count() == 0


@given(st.lists(st.text(alphabet="ab \n\té𝒳", max_size=30), min_size=1, max_size=6), st.integers(1, 5))
@settings(max_examples=100, deadline=None)
def test_word_hashes_and_rolling(texts, width):
    hashes, bounds = wordhash.word_hashes([t.encode() for t in texts])
    words = [w for t in texts for w in t.encode().split()]
    assert len(hashes) == len(words) and [b - a for a, b in zip(bounds, bounds[1:])] == [len(t.encode().split()) for t in texts]
    same = defaultdict(set)
    for w, h in zip(words, hashes.tolist()):
        same[w].add(h)
    assert all(len(s) == 1 for s in same.values()) and len({h for s in same.values() for h in s}) == len(same)
    runs = defaultdict(set)
    for i, h in enumerate(wordhash.rolling(hashes, width, wordhash.BASES[1]).tolist()):
        runs[tuple(words[i:i + width])].add(h)
    assert all(len(s) == 1 for s in runs.values()) and len({h for s in runs.values() for h in s}) == len(runs)


@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=50))
def test_packed_hashes(values):
    v = np.unique(np.array(values, np.uint32))
    assert np.array_equal(repeats.unpack(repeats.pack(v)), v)

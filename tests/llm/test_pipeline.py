"""The pipeline: each stage on its own input, against brute force."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from lakeload.llm import mixing, secret_scan, toxicity
from lakeload.llm.common import stored
from test_dedup_and_layout import brute_classes
from test_scans import brute_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, documents):
    """What each stage read, by name, and what the last returned."""
    out, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs
        docs = stored(stage(spark, docs, SF), "test_stage")
    return out | {"end": docs}


def test_stages_keep_the_columns(kept, documents):
    assert all(kept[name].dtypes == documents.dtypes for name, _ in corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "secrets", "mixing", "bpe"]


def test_toxicity_stage(spark, kept):
    bad = {r.doc_id for r in toxicity.op6_toxic_segments(spark, SF).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept["near_dedup"].collect()} == {r.doc_id for r in kept["toxicity"].collect()} - bad


def test_near_stage(kept):
    rows = sorted(kept["near_dedup"].collect())
    want = [rows[i].doc_id for i in sorted(set(brute_classes([r.text for r in rows])))]
    assert sorted(r.doc_id for r in kept["secrets"].collect()) == want


def test_secret_stage(kept):
    before = {r.doc_id: r.text for r in kept["secrets"].collect()}
    after = {r.doc_id: r for r in kept["mixing"].collect()}
    assert set(before) == set(after)
    for i, text in before.items():
        assert sum(brute_spans(after[i].text)[:3]) == 0
        if not sum(brute_spans(text)[:3]) and secret_scan.MASK not in after[i].text:
            assert after[i].text == text


def test_mixing_stage(kept):
    taken = mixing.mix(kept["mixing"]).collect()
    words = Counter()
    for r in kept["bpe"].collect():
        words[r.doc_id] += len(r.text.encode().split())
    assert {r.doc_id: r.taken for r in taken if r.taken} == dict(words)


def test_last_stage(kept):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in kept["bpe"].collect():
        ids = t.encode(r.text, add_special_tokens=False).ids
        want[(r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in kept["end"].collect()) == want


def test_run_equals_the_stages(spark, kept):
    got = __spark_entry__.queries()["pipeline"](spark, SF)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, kept["end"].collect()))


def test_repeated_rows_and_nulls(spark, messy):
    docs = messy
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test_messy")
        assert name == "bpe" or docs.dtypes == messy.dtypes
    assert docs.count() > 0

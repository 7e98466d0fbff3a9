"""From raw documents to token ids: five stages, each one of the training-data operators.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeload.llm import bpe, mixing, near_dups, secret_scan, toxicity
from lakeload.llm.common import read_table, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.with_score(docs, model, "__tox").where("__tox.score < 0.5").drop("__tox")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the smallest id."""
    return near_dups.one_of_each(docs, near_dups.near_classes(docs))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return secret_scan.mask_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: whole documents, some twice, some not at all, one per source in part."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    return bpe.digests(bpe.with_ids(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot express the stages' models, signatures and merges; tests compare with brute force.
ORACLE_SQL = None

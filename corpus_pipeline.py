"""A training-data pipeline over ``documents``, stage by stage.

quality   documents that the quality classifier rejects go
dedup     of each group of SimHash near-duplicates the smallest doc_id stays
secrets   secrets are replaced by a mark; no document goes
mix       documents are taken as often as their source's target says
tokens    token ids and decoded text of what is left, as digests

Each stage gets ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
before the next one reads it. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusweave.llm import bpe, mixing, quality, secrets, simhash
from corpusweave.session import importable, written
from corpusweave.sources.tables import table

TOKENIZER = "byte_bpe_50k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("dedup", dedup_stage),
    ("secrets", secrets_stage),
    ("mix", mix_stage),
    ("tokens", tokens_stage),
]

# Trained models and word hashes decide here, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: one per document of the mix."""
    docs = table(importable(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.llm import ann, bpe, collocations, embdedup, langid, mixing, packing, quality, secrets, simhash, trie, url_lm, warc
from corpusweave.llm.oracle import LLM_ORACLE  # noqa: F401
from corpusweave.session import importable, run_dir, temporary
from corpusweave.sources.tables import table

# The rules of the URL filter's contract.
URL_RULES = (
    url_lm.Rule("allow", "org", "/"),
    url_lm.Rule("block", "example.org", "/es/"),
    url_lm.Rule("block", "example.org", "/en/1"),
    url_lm.Rule("allow", "com", "/fr/"),
    url_lm.Rule("block", "com", "/de/"),
)


def op1_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return url_lm.judge(table(spark, d, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_warc(spark: SparkSession, d: str) -> DataFrame:
    folder = run_dir(spark, "warc")
    warc.write_archive(table(spark, d, "pages"), folder)
    return warc.read_archive(temporary(spark, folder), folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_ann(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op4_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.judge(table(spark, d, "documents"), table(spark, d, "labels"))


def op5_bpe(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"))


def op7_language(spark: SparkSession, d: str) -> DataFrame:
    return langid.judge(table(spark, d, "documents"))


def op8_embedding_dedup(spark: SparkSession, d: str) -> DataFrame:
    return embdedup.linked(table(spark, d, "embeddings"))


def op9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(table(spark, d, "documents"))


def op10_secrets(spark: SparkSession, d: str) -> DataFrame:
    return secrets.find_secrets(table(spark, d, "documents"))


def op11_packing(spark: SparkSession, d: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(table(spark, d, "documents"))


def op13_trie(spark: SparkSession, d: str) -> DataFrame:
    return trie.conversation_trie(table(spark, d, "conversations"))


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: query(importable(spark), d)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: _ready(q)
    for q in (
        op1_url_filter, op2_warc, op3_ann, op4_quality, op5_bpe, op6_simhash, op7_language, op8_embedding_dedup, op9_mix, op10_secrets,
        op11_packing, op12_collocations, op13_trie,
    )
}

"""Bounded labelled samples for the classifiers."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of doc_id as text, modulo ``mod``; null without doc_id."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % mod).cast("int")


def sampled(labelled: DataFrame, rows: int, by: str | None = None) -> DataFrame:
    """At most ``rows`` ids of ``labelled(doc_id, label)``, the first by a hash of
    doc_id, for each value of ``by`` if given. Only ids and labels are sorted."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    if by is None:
        return labelled.orderBy(*order).limit(rows)
    from pyspark.sql import Window as W

    place = F.row_number().over(W.partitionBy(by).orderBy(*order))
    return labelled.withColumn("_place", place).where(F.col("_place") <= rows).drop("_place")


def seeded(*key: object) -> np.random.Generator:
    return np.random.default_rng(int.from_bytes(hashlib.sha256(repr(key).encode()).digest()[:8], "little"))

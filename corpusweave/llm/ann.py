"""Nearest neighbours by inner product, through randomly rotated one-bit codes.

Queries meet all vectors block by block. In a block pair the packed codes give
an estimate of every inner product and bounds around it; a vector whose upper
bound stays below the ``k``-th largest lower bound of the query cannot be among
its nearest and is passed over, the others are reranked in double precision on
the original vectors. Each block pair hands on ``k`` rows a query, and the best
``k`` of these are the answer.

A block pair holds at most about ``block`` vectors and ``query_block`` queries.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusweave.llm import codes
from corpusweave.session import written


@dataclass(frozen=True)
class AnnConfig:
    """``z``: deviations of the error bound; ``bits_per_dim``: code length."""

    k: int = 20
    bits_per_dim: int = 4
    z: float = 3.0
    seed: int = 7
    block: int = 4096
    query_block: int = 4096


_FOUND = "query_id long, vec_id long, score double"
_CHUNK = 256


def _search(dim: int, bits: int, config: AnnConfig):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        q_ids, v_ids = (t.column("vec_id").to_numpy() for t in (queries, vectors))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(q_ids) and len(v_ids):
            q = codes.matrix(queries.column("embedding").combine_chunks(), dim).astype(np.float64)
            x = codes.matrix(vectors.column("embedding").combine_chunks(), dim).astype(np.float64)
            norm, l1 = (vectors.column(c).to_numpy() for c in ("norm", "l1"))
            s = codes.signs(vectors.column("code").combine_chunks(), bits)
            scale = (norm / l1).astype(np.float32)
            spread = (config.z * norm * codes.error_scale(l1, bits)).astype(np.float32)
            turned = (q @ codes.rotation(dim, bits, config.seed)).astype(np.float32)
            lengths = np.sqrt((q * q).sum(axis=1)).astype(np.float32)
            for at in range(0, len(q), _CHUNK):
                part = slice(at, at + _CHUNK)
                guess = (turned[part] @ s.T) * scale
                wide = lengths[part, None] * spread
                low = guess - wide
                low[q_ids[part, None] == v_ids] = -np.inf  # a query's own row is no candidate
                high = guess + wide
                high[np.isneginf(low)] = -np.inf
                k = min(config.k, len(v_ids))
                floor = np.partition(low, len(v_ids) - k, axis=1)[:, len(v_ids) - k]
                for i in range(len(guess)):
                    near = np.flatnonzero((high[i] >= floor[i]) & (high[i] > -np.inf))
                    exact = x[near] @ q[at + i]
                    best = np.lexsort((v_ids[near], -exact))[: config.k]
                    found.append((np.full(len(best), q_ids[at + i]), v_ids[near[best]], exact[best]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), columns, kinds, strict=True)})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, config: AnnConfig = AnnConfig()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` vectors of largest inner
    product for each query, ties to the smaller vec_id.

    Both inputs have ``vec_id, embedding``; rows with the query's own vec_id are
    no candidates. Vectors that are null, zero, hold null or non-finite numbers,
    or differ in length from most take no part, nor do rows without vec_id. Fewer
    than ``k`` candidates give fewer rows; repeated rows are candidates each.
    Extra columns are ignored.
    """
    named = F.col("vec_id").isNotNull()
    vectors, queries = (t.select("vec_id", "embedding").where(named) for t in (vectors, queries))
    dim = codes.dimension(vectors)
    schema = "query_id long, rank int, vec_id long, score double"
    if dim is None:
        return vectors.sparkSession.createDataFrame([], schema)
    bits = -(-max(64, config.bits_per_dim * dim) // 8) * 8
    store = written(codes.coded(vectors, dim, bits, config.seed), "ann-codes")
    asked = queries.where(codes.usable(F.col("embedding")) & (F.size("embedding") == dim)).distinct()
    asked = written(asked.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>")), "ann-queries")
    blocks = max(1, math.ceil(store.count() / config.block))
    query_blocks = max(1, math.ceil(asked.count() / config.query_block))

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = asked.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("qb")).select("*", every(blocks).alias("vb"))
    right = store.select("vec_id", "embedding", "code", "norm", "l1", F.pmod(F.xxhash64("digest", "vec_id"), F.lit(blocks)).cast("int").alias("vb"))
    right = right.select("*", every(query_blocks).alias("qb"))
    search = _search(dim, bits, config)
    found = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInArrow(lambda a, b: search(a, b), _FOUND)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= config.k).select("query_id", "rank", "vec_id", "score")

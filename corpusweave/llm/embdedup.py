"""Near-duplicate vectors by cosine, through randomised-rotation binary codes.

Equal vectors are taken together first, with their number. Bits of the rotated
codes then form bands; two vectors of cosine ``t`` agree in a bit with
probability ``1 - acos(t) / pi``, so the number of bits a band and of bands
follows from the rows and from ``miss``, the chance that a pair just at the
threshold shares no band (nearer pairs are missed far less). Within a band's
bucket the codes and their stored correction factors estimate every cosine with
a confidence bound: a pair whose upper bound is below the threshold is passed
over, every other is computed exactly, in double precision.

A bucket hands on link counts and a spanning star of each group it finds, never
its pairs. A pair that shares several bands is counted in the first of them. A
bucket of more than ``block`` vectors is dealt out over pairs of blocks, so no
task holds more than two blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusweave.llm import codes
from corpusweave.llm.components import components
from corpusweave.session import written


@dataclass(frozen=True)
class EmbeddingDedupConfig:
    threshold: float = 0.95
    miss: float = 1e-4
    bucket: int = 256
    block: int = 2048
    z: float = 4.0
    seed: int = 11


def _bands(rows: int, config: EmbeddingDedupConfig) -> tuple[int, int]:
    """Bits a band, so that chance buckets hold about ``bucket`` rows, and bands."""
    width = min(62, max(8, math.ceil(math.log2(max(2, rows) / config.bucket))))
    agree = (1 - math.acos(config.threshold) / math.pi) ** width
    return width, math.ceil(math.log(config.miss) / math.log1p(-agree))


def _keys(packed: np.ndarray, width: int, bands: int) -> np.ndarray:
    """Bucket number of each row in each band, from the packed code."""
    bits = np.unpackbits(packed, axis=1, bitorder="little")[:, : width * bands].reshape(len(packed), bands, width)
    return bits.astype(np.int64) @ (np.int64(1) << np.arange(width, dtype=np.int64))


def _with_keys(store: DataFrame, width: int, bands: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
            keys = _keys(packed, width, bands)
            flat = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, flat], [*batch.schema.names, "keys"])

    return store.mapInArrow(run, "digest string, n long, embedding array<float>, code binary, norm double, l1 double, keys array<long>")


def _linker(dim: int, bits: int, config: EmbeddingDedupConfig):
    def run(table: pa.Table) -> pa.Table:
        """Weighted links and one star link for each row of a bucket or block pair."""
        band, i, j = (table.column(c)[0].as_py() for c in ("band", "i", "j"))
        sub, n, norm, l1 = (table.column(c).to_numpy() for c in ("sub", "n", "norm", "l1"))
        names = np.array(table.column("digest").to_pylist(), dtype=object)
        x = codes.matrix(table.column("embedding").combine_chunks(), dim).astype(np.float64) / norm[:, None]
        keys = table.column("keys").combine_chunks().flatten().to_numpy().reshape(len(x), -1)
        s = codes.signs(table.column("code").combine_chunks(), bits)
        turned = (x @ codes.rotation(dim, bits, config.seed)).astype(np.float32)
        wide = config.z * codes.error_scale(l1, bits)
        links, root = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        left = np.flatnonzero(sub == i)
        right = left if i == j else np.flatnonzero(sub == j)
        for at in range(0, len(left), 512):
            rows = left[at : at + 512]
            guess = (turned[rows] @ s[right].T) / l1[right]
            maybe = guess + wide[right] >= config.threshold
            if i == j:
                maybe &= rows[:, None] < right
            a, b = np.nonzero(maybe)
            a, b = rows[a], right[b]
            for part in range(0, len(a), 1 << 16):
                one, other = a[part : part + (1 << 16)], b[part : part + (1 << 16)]
                hit = np.einsum("ij,ij->i", x[one], x[other]) >= config.threshold
                one, other = one[hit], other[hit]
                fresh = ~(keys[one, :band] == keys[other, :band]).any(axis=1)
                np.add.at(links, one[fresh], n[other[fresh]])
                np.add.at(links, other[fresh], n[one[fresh]])
                root = _joined(root, one, other)
        keep = (links > 0) | (root != np.arange(len(x)))
        return pa.table({
            "digest": pa.array(names[keep].tolist(), pa.string()), "links": pa.array(links[keep]),
            "root": pa.array(names[root[keep]].tolist(), pa.string()),
        })

    return run


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking ``a`` to ``b``: the smallest row that links reach."""
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for at in (a, b, root[a], root[b]):
            np.minimum.at(new, at, low)
        while (flat := new[new]).tobytes() != new.tobytes():
            new = flat
        if (new == root).all():
            return root
        root = new


def linked(vectors: DataFrame, config: EmbeddingDedupConfig = EmbeddingDedupConfig()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors(vec_id, embedding)``.

    ``n_links`` counts other rows at cosine ``threshold`` or more, equal vectors
    included; ``component_id`` is the smallest vec_id that links reach. Vectors
    that are null, zero, hold null or non-finite numbers, or differ in length
    from most link with nothing. Rows without vec_id take part but name no
    component and are not kept. Extra columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    dim = codes.dimension(rows)
    unlinked = ["vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")]
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    if dim is None:
        return rows.select(*unlinked).select("*", kept)
    width, bands = _bands(rows.count(), config)
    bits = -(-max(64, 4 * dim, width * bands) // 8) * 8
    store = written(codes.coded(rows, dim, bits, config.seed), "embedding-codes")
    parts = [F.first(c).alias(c) for c in ("embedding", "code", "norm", "l1")]
    distinct = store.groupBy("digest").agg(F.count("*").alias("n"), *parts)
    distinct = written(_with_keys(distinct, width, bands), "embedding-distinct")

    entries = distinct.select("*", F.posexplode("keys").alias("band", "key"))
    counts = entries.groupBy("band", "key").agg(F.count("*").alias("_size")).where("_size > 1")
    blocks = F.ceil(F.col("_size") / config.block).cast("int")
    placed = entries.join(counts, ["band", "key"]).withColumn("_k", blocks).withColumn(
        "sub", F.pmod(F.xxhash64("digest"), F.col("_k")).cast("int")
    )
    pairs = F.transform(F.sequence(F.lit(0), F.col("_k") - 1), lambda o: F.struct(
        F.least("sub", o).alias("i"), F.greatest("sub", o).alias("j")
    ))
    dealt = placed.drop("_size").select("*", F.explode(pairs).alias("_p")).select("*", "_p.i", "_p.j").drop("_p", "_k")
    link = _linker(dim, bits, config)
    found = dealt.groupBy("band", "key", "i", "j").applyInArrow(lambda t: link(t), "digest string, links long, root string")
    found = written(found, "embedding-links")

    weights = found.groupBy("digest").agg(F.sum("links").alias("links"))
    joined = components(found.where("digest <> root").select(F.col("digest").alias("a"), F.col("root").alias("b")))
    sizes = store.groupBy("digest").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    sizes = sizes.join(joined.withColumnRenamed("id", "digest"), "digest", "left").join(weights, "digest", "left")
    sizes = written(sizes.select(
        "digest", "first", F.coalesce("component", "digest").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    ), "embedding-sizes")
    least = sizes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = sizes.join(least, "component").select("digest", "n_links", "component_id")
    known = store.select("vec_id", "digest").join(named, "digest").select("vec_id", "n_links", "component_id")
    part = codes.usable(F.col("embedding")) & (F.size("embedding") == dim)
    rest = rows.where(~part).select(*unlinked)
    return known.unionByName(rest).select("*", kept)

"""Randomly rotated one-bit codes of vectors, with correction scalars.

A vector of ``d`` numbers is scaled to length one, padded to ``bits`` dimensions,
rotated at random, and only the signs are kept. With ``r`` the rotated vector and
``s`` its signs, ``<s, Rq> / |r|_1`` estimates the inner product with a query
``q`` without bias: what the signs add at right angles to ``r`` points in a
random direction. Its size is known from ``|r|_1``, which gives a confidence
bound of ``z`` deviations::

    |estimate - true| <= z * |q| * |x| * sqrt(bits - |r|_1^2) / (|r|_1 * sqrt(bits - 1))

The norm and ``|r|_1`` are the correction scalars stored with the packed bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@lru_cache(maxsize=4)
def rotation(dim: int, bits: int, seed: int) -> np.ndarray:
    """``dim`` orthonormal rows in ``bits`` dimensions: padding and rotation in one."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dim)))
    return (q * np.sign(np.diag(r))).T.copy()


def usable(vector: Column) -> Column:
    """Not null, not zero, every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def dimension(vectors: DataFrame) -> int | None:
    """The most common length of the usable vectors (the smaller of equally common ones)."""
    row = (
        vectors.where(usable(F.col("embedding"))).groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "d").first()
    )
    return row["d"] if row else None


CODED = "vec_id long, embedding array<float>, digest string, code binary, norm double, l1 double"


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def coded(vectors: DataFrame, dim: int, bits: int, seed: int) -> DataFrame:
    """Usable vectors of length ``dim`` with packed code, norm, ``|r|_1`` and a
    digest that is equal for equal vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dim, bits, seed)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1), dim).astype(np.float32) + np.float32(0)  # -0 becomes 0
            wide = x.astype(np.float64)
            norm = np.sqrt((wide * wide).sum(axis=1))
            r = (wide / norm[:, None]) @ turn
            code = np.packbits(r > 0, axis=1, bitorder="little")
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([hashlib.blake2b(row.tobytes(), digest_size=16).hexdigest() for row in x]),
                pa.array([row.tobytes() for row in code], pa.binary()), pa.array(norm), pa.array(np.abs(r).sum(axis=1)),
            ], ["vec_id", "embedding", "digest", "code", "norm", "l1"])

    rows = vectors.where(usable(F.col("embedding")) & (F.size("embedding") == dim))
    return rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>")).mapInArrow(run, CODED)


def signs(codes: pa.Array, bits: int) -> np.ndarray:
    """Packed codes as rows of -1 and 1."""
    packed = np.frombuffer(b"".join(codes.to_pylist()), dtype=np.uint8).reshape(len(codes), -1)
    return np.unpackbits(packed, axis=1, bitorder="little")[:, :bits].astype(np.float32) * 2 - 1


def error_scale(l1: np.ndarray, bits: int) -> np.ndarray:
    """Deviation of the estimate for a query and a vector of length one."""
    return np.sqrt(np.maximum(bits - l1 * l1, 0)) / (l1 * np.sqrt(bits - 1))

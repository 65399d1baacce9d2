"""Ordered scans that no single task has to hold.

A running value over one hot key, or over the whole log, would put every row of
it into one window task. Here rows are range-partitioned by (keys, order), each
range is scanned on its own, and what earlier ranges of the same key add up to
is carried over. The local scan is written once, because the scan and the carry
must see the same ranges.

Ranges follow the key order, so each range border splits at most one key: there
are fewer carries than ranges, however many keys there are, and broadcasting
them is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusweave.session import shuffle_width, written

BUCKET = "_range"


def _bucketed(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    ranged = df.repartitionByRange(shuffle_width(df.sparkSession), *keys, *order)
    return ranged.withColumn(BUCKET, F.spark_partition_id())


def _local_window(keys: list[str], order: list[str]):
    return W.partitionBy(*keys, BUCKET).orderBy(*order)


def _earlier(keys: list[str]):
    by = keys if keys else [F.lit(0)]
    return W.partitionBy(*by).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)


def _carried(local: DataFrame, carries: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Attach the carries of split keys; there are fewer of them than ranges."""
    split = carries.where(F.coalesce(*names).isNotNull()).select(
        *(F.col(k).alias(f"_of_{k}") for k in keys), F.col(BUCKET).alias("_of_range"), *names
    )
    same = F.col(BUCKET) == F.col("_of_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return local.join(F.broadcast(split), same, "left").drop("_of_range", *(f"_of_{k}" for k in keys))


def ordinals(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """0-based position of each row within its keys; ``order`` must be unique there."""
    w = _local_window(keys, order)
    local = written(_bucketed(df, keys, order).withColumn("_rn", F.row_number().over(w).cast("long") - 1), "scan")
    totals = local.groupBy(*keys, BUCKET).agg(F.count("*").alias("_n"))
    carries = totals.withColumn("_off", F.sum("_n").over(_earlier(keys)))
    position = F.coalesce("_off", F.lit(0)) + F.col("_rn")
    return _carried(local, carries, keys, ["_off"]).withColumn(name, position).drop("_off", "_rn", BUCKET)


def running_total(df: DataFrame, keys: list[str], at: str, delta: Column, name: str) -> DataFrame:
    """Running sum of ``delta`` per key after each distinct ``at``.

    Rows that share a key and an instant are summed before any shuffle.
    """
    steps = df.groupBy(*keys, at).agg(F.sum(delta).alias("_d"))
    w = _local_window(keys, [at]).rowsBetween(W.unboundedPreceding, 0)
    local = written(_bucketed(steps, keys, [at]).withColumn("_s", F.sum("_d").over(w)), "scan")
    totals = local.groupBy(*keys, BUCKET).agg(F.sum("_d").alias("_t"))
    carries = totals.withColumn("_off", F.sum("_t").over(_earlier(keys)))
    total = F.col("_s") + F.coalesce("_off", F.lit(0))
    return _carried(local, carries, keys, ["_off"]).select(*keys, at, total.alias(name))


def fifo_gate(
    df: DataFrame, keys: list[str], order: list[str], ready: str, interval: Column, name: str, last: str | None = None,
) -> DataFrame:
    """Earliest admission times: ``start_i = max(ready_i, start_{i-1} + interval_i)``.

    With ``D_i`` the running sum of intervals a row's start is
    ``D_i + max_{j<=i}(ready_j - D_j)``: a running sum and a running maximum,
    which scan in ranges. ``last`` names a column with the key's previous
    admission, if there was one.
    """
    ordered = _local_window(keys, order).rowsBetween(W.unboundedPreceding, 0)
    local = _bucketed(df, keys, order).withColumn("_gap", interval.cast("long"))
    local = local.withColumn("_d", F.sum("_gap").over(ordered))
    local = written(local.withColumn("_m", F.max(F.col(ready) - F.col("_d")).over(ordered)), "scan")
    totals = local.groupBy(*keys, BUCKET).agg(F.sum("_gap").alias("_t"), F.max("_m").alias("_bm"))
    earlier = _earlier(keys)
    carries = totals.withColumn("_off", F.sum("_t").over(earlier)).withColumn(
        "_carry", F.max(F.col("_bm") - F.coalesce("_off", F.lit(0))).over(earlier)
    )
    offset = F.coalesce("_off", F.lit(0))
    before = F.greatest("_carry", last) if last else F.col("_carry")
    start = offset + F.col("_d") + F.greatest(before, F.col("_m") - offset)
    out = _carried(local, carries, keys, ["_off", "_carry"]).withColumn(name, start)
    return out.drop("_off", "_gap", "_d", "_m", "_carry", BUCKET)

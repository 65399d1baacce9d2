"""Archived-page lookups: the batch download of a URL list as a join."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.operators import extract as X
from corpusweave.session import written

# Answers up to this measured size are broadcast to the pages.
BROADCAST_BYTES = 64 * 1024 * 1024


def corpus_scan(pages: DataFrame) -> DataFrame:
    return pages.select("url", "html")


def _answers(urls: DataFrame, pages: DataFrame, every_copy: bool) -> tuple[DataFrame, DataFrame, bool]:
    """Requested URLs, the page that answers each, and whether the answers are
    few enough to broadcast.

    The page is chosen on (url, page_id) alone, reduced before the shuffle, so a
    URL with very many copies is no burden. A page without page_id answers nothing.
    With ``every_copy`` all pages of a URL answer it, and the answers are URLs alone.
    """
    wanted = urls.select("url").distinct()
    if every_copy:
        archived = pages.select("url").distinct()
    else:
        archived = pages.where("page_id is not null").groupBy("url").agg(F.min("page_id").alias("page_id"))
    first = written(archived.join(wanted, "url", "left_semi"), "answers")
    size = first.agg(F.sum(F.octet_length("url") + F.lit(64))).first()[0] or 0
    return wanted, first, size <= BROADCAST_BYTES


# Bits of the filter of wanted pages: so many for each of them, up to a size that every task can hold.
BITS_EACH, MOST_BITS, PROBES = 12, 1 << 26, 4
# Bits that a plan can carry: the driver writes them out as text, at every mention and for every plan it keeps.
PLAN_BITS = 1 << 17


def _probe(page_id: Column, probe: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(page_id, F.lit(probe)), F.lit(bits))


def _held_by_tasks(spark: SparkSession, table: np.ndarray, bits: int) -> Callable[[Column], Column]:
    """Whether all bits of an id are set in a table that was broadcast; the plan does not name it."""
    import pyarrow as pa

    held = spark.sparkContext.broadcast(table)

    def all_set(a, b, c, d):
        import pyarrow as pa

        found = True
        for place in (a, b, c, d):
            p = place.to_numpy(zero_copy_only=False)
            found = found & ((held.value[p >> 6] >> (p & 63)) & 1 == 1)
        return pa.array(found, pa.bool_())

    all_set.__annotations__ = dict.fromkeys(["a", "b", "c", "d", "return"], pa.Array)
    return lambda page_id: F.arrow_udf(all_set, "boolean")(*(_probe(page_id, k, bits) for k in range(PROBES)))


def bloom_filter(ids: DataFrame, column: str) -> Callable[[Column], Column]:
    """A predicate that every id of ``ids`` passes and few others do.

    Bits are set by tasks and combined before they move; the driver sees at most
    ``MOST_BITS``. More ids than that is meant for let more others pass. Up to
    ``PLAN_BITS`` stand in the plan; beyond, tasks hold them as a broadcast.
    """
    n = ids.count()
    bits = min(MOST_BITS, 1 << max(10, (BITS_EACH * n - 1).bit_length()))
    probes = F.explode(F.array(*(_probe(F.col(column), k, bits) for k in range(PROBES))))
    words = ids.select(probes.alias("_b")).groupBy((F.col("_b") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_b % 64 as int))")).alias("mask")
    ).toArrow()
    table = np.zeros(bits // 64, dtype="<i8")
    table[words.column("word").to_numpy()] = words.column("mask").to_numpy()
    if bits > PLAN_BITS:
        return _held_by_tasks(ids.sparkSession, table, bits)
    stored = F.lit(table.tobytes())

    def passes(page_id: Column) -> Column:
        found = F.lit(True)
        for k in range(PROBES):
            bit = _probe(page_id, k, bits)
            byte = F.conv(F.hex(F.substring(stored, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            found = found & (F.getbit(byte, (bit % 8).cast("int")) == 1)
        return found

    return passes


def _looked_up(urls: DataFrame, pages: DataFrame, build: Callable[[DataFrame], DataFrame], absent: Callable[[DataFrame], DataFrame],
               every_copy: bool = False) -> DataFrame:
    """What ``build`` makes of the pages that answer, and ``absent`` of URLs without one.

    Built where the page was read. Up to ``BROADCAST_BYTES`` of answers nothing of a
    page moves; beyond, a Bloom filter of the wanted pages leaves few others
    to build from, and what was built moves once.
    """
    wanted, first, few = _answers(urls, pages, every_copy)
    answer = first.columns
    if few:
        found = build(pages.join(F.broadcast(first), answer, "left_semi"))
    else:
        wants = bloom_filter(first, answer[-1])
        # By the size of its files a table of URLs seems small enough to broadcast long after it is not.
        first = first.hint("merge")
        found = build(pages.where(wants(F.col(answer[-1])))).join(first, answer, "left_semi")
    kept = found if every_copy else found.drop("page_id")
    return kept.unionByName(absent(wanted.join(first, "url", "left_anti")), allowMissingColumns=every_copy)


def batch_lookup(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """One row per requested URL with its body, ``''`` when there is none."""
    return _looked_up(
        urls, pages, lambda found: found.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")),
        lambda missing: missing.select("url", F.lit("").alias("html")),
    )


def is_fetched(html: Column) -> Column:
    return F.length(F.coalesce(html, F.lit(""))) > 0


def fetch_status(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """Status and body length of each requested URL; only the length leaves a page."""
    length = F.length(F.coalesce("html", F.lit(""))).alias("length")
    found = _looked_up(
        urls, pages, lambda found: found.select("page_id", "url", length), lambda missing: missing.select("url", F.lit(0).alias("length"))
    )
    return found.select("url", F.when(F.col("length") > 0, "OK").otherwise("ERROR").alias("status"), "length")


def fetch_and_extract(urls: DataFrame, pages: DataFrame, every_copy: bool = False) -> DataFrame:
    """Page record per requested URL; an unfetched page gets the failed record.
    Records are made where their page was read, before anything moves. With
    ``every_copy`` a URL that was archived more than once has a record a copy, with its page_id."""
    def records(found: DataFrame) -> DataFrame:
        whole = found.withColumn("html", F.coalesce("html", F.lit("")))
        return X.with_fetch_failures(X.page_records(whole, missing=~is_fetched(F.col("html"))), F.col("missing")).drop("missing")

    return _looked_up(urls, pages, records, lambda missing: records(missing.withColumn("html", F.lit(""))), every_copy)

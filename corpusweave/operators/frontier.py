"""Frontier operators: candidate filters, merging, top-k and state reduction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusweave.functions import urls as U
from corpusweave.functions.binding import settled


def seed_domains(seeds: DataFrame) -> DataFrame:
    return seeds.where(U.is_web_url(U.clean(F.col("url")))).select(U.domain(F.col("url")).alias("domain")).distinct()


def domain_counts(urls: DataFrame, column: str = "url") -> DataFrame:
    return urls.groupBy(U.domain_or_unknown(F.col(column)).alias("domain")).agg(F.count("*").alias("n"))


def normalized(candidates: DataFrame, column: str = "url") -> DataFrame:
    return settled(candidates, column, U.normalize(F.col(column)))


def valid_only(candidates: DataFrame) -> DataFrame:
    return candidates.where(U.is_web_url(F.col("url")))


def unknown_only(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates not visited, processed or failed before."""
    return candidates.join(known.select("url").distinct(), "url", "left_anti")


def same_domain_only(candidates: DataFrame, domains: DataFrame) -> DataFrame:
    keyed = candidates.withColumn("_domain", U.domain(F.col("url")))
    return keyed.join(domains.select(F.col("domain").alias("_domain")), "_domain", "left_semi").drop("_domain")


def exclude_matching(candidates: DataFrame, patterns: tuple[str, ...]) -> DataFrame:
    return candidates.where(~U.matches_any(F.col("url"), patterns)) if patterns else candidates


def include_matching(candidates: DataFrame, patterns: tuple[str, ...]) -> DataFrame:
    return candidates.where(U.matches_any(F.col("url"), patterns)) if patterns else candidates


def crawlable(
    candidates: DataFrame, known: DataFrame | None = None, domains: DataFrame | None = None,
    exclude: tuple[str, ...] = (), include: tuple[str, ...] = (),
) -> DataFrame:
    """The whole crawl predicate on normalised candidates; row-wise filters run
    before the joins so that only survivors are shuffled."""
    kept = include_matching(exclude_matching(valid_only(candidates), exclude), include)
    if domains is not None:
        kept = same_domain_only(kept, domains)
    return unknown_only(kept, known) if known is not None else kept


def frontier_merge(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates (seq, url, priority, depth) that enter the frontier: not empty
    and not known; the first arrival of a URL keeps its priority and depth."""
    first = (
        candidates.where(F.coalesce(F.col("url"), F.lit("")) != "")
        .groupBy("url")
        .agg(F.min(F.struct("seq", "priority", "depth")).alias("f"))
        .select("url", "f.seq", "f.priority", "f.depth")
    )
    return unknown_only(first, known)


def frontier_topk(frontier: DataFrame, k: int) -> DataFrame:
    """Next k URLs: highest priority first, first in first out on ties."""
    return frontier.orderBy(F.desc("priority"), F.asc("seq")).limit(k)


def depth_lookup(urls: DataFrame, frontier: DataFrame) -> DataFrame:
    """Depth of each URL, 0 when it was never queued; frontier is unique by url."""
    return urls.join(frontier.select("url", "depth"), "url", "left").select(
        *urls.columns, F.coalesce("depth", F.lit(0)).alias("depth")
    )


def url_state(events: DataFrame) -> DataFrame:
    """Reduce (url, state, reason, seq): one row per (url, state), latest reason.

    A URL may be in several states; pre-aggregation keeps hot URLs cheap.
    """
    return events.groupBy("url", "state").agg(F.max_by("reason", "seq").alias("reason"))


def queue_stats(crawl: DataFrame) -> DataFrame:
    """Counts by status; a robots-blocked URL counts as failed here."""
    counted = crawl.agg(
        F.count_if(F.col("status") == "queued").alias("queued"),
        F.count_if(F.col("status") == "processed").alias("processed"),
        F.count_if(F.col("status").isin("failed", "blocked")).alias("failed"),
    )
    return counted.withColumn("total_known", F.col("queued") + F.col("processed") + F.col("failed"))

"""Schedules, rates and concurrency over request logs.

A request log is (req_id, url, domain, arrival_us, ...). Times are whole
microseconds, so results are exact. Runs over one key or the whole log go
through ``scans`` and never through a single window task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.config import PolitenessConfig, at_least
from corpusweave.functions import urls as U
from corpusweave.operators.robots import delay_for_agent
from corpusweave.operators.scans import fifo_gate, ordinals, running_total
from corpusweave.session import checkpointed

# Keys of requests that name no domain, when they are paced and
# when they are counted, and the trailing window.
DEFAULT_KEY = "__default__"
UNKNOWN_KEY = "unknown"
TRAILING_US = 1_000_000
ORDER = ["arrival_us", "req_id"]


def _keyed(requests: DataFrame, blank_key: str = DEFAULT_KEY) -> DataFrame:
    blank = F.coalesce(F.col("domain"), F.lit("")) == ""
    return requests.withColumn("domain", F.when(blank, blank_key).otherwise(F.col("domain")))


def rate_schedule(requests: DataFrame, config: PolitenessConfig) -> DataFrame:
    """Add ``start_us``: first-in-first-out admission at the effective rate, per
    domain or, with ``per_domain=False``, over all requests together.

    Intervals are added up in nanoseconds, so a rate that is no whole number of
    microseconds does not drift; a start is the next whole microsecond.
    """
    keys = ["domain"] if config.per_domain else []
    fine = _keyed(requests).withColumn("_ns", F.col("arrival_us") * 1000)
    gated = fifo_gate(fine, keys, ORDER, "_ns", F.lit(config.interval_ns), "_start_ns")
    return gated.withColumn("start_us", F.expr("(_start_ns + 999) div 1000")).drop("_ns", "_start_ns")


def crawl_delay_schedule(requests: DataFrame, robots_source: DataFrame, config: PolitenessConfig) -> DataFrame:
    """Add ``start_us`` of the rate gate and ``final_us`` after the second gate,
    which keeps the robots delay of each request's site between the requests of
    a domain. Requests without a delay pass it untouched and unnoticed."""
    gated = rate_schedule(requests, config)
    if not config.respect_robots:
        return gated.withColumn("final_us", F.col("start_us"))
    delays = delay_for_agent(robots_source, config.user_agent).where(F.col("delay") > 0).select(
        F.col("base_url").alias("_base"), F.round(F.col("delay") * 1_000_000).cast("long").alias("_delay_us")
    )
    delays = checkpointed(delays)
    timed = gated.withColumn("_base", U.base_url(F.col("url"))).join(delays, "_base", "left").drop("_base")
    held = timed.where(F.col("_delay_us") > 0)
    free = timed.where(F.coalesce(F.col("_delay_us"), F.lit(0)) <= 0).withColumn("final_us", F.col("start_us"))
    out = fifo_gate(held, ["domain"], ["start_us", "req_id"], "start_us", F.col("_delay_us"), "final_us")
    return out.unionByName(free).drop("_delay_us")


def jitter_us(jitter: float, *identity: Column) -> Column:
    """Uniform in [0, jitter], fixed by the request's identity so reruns agree."""
    if jitter == 0:
        return F.lit(0).cast("long")
    fraction = F.pmod(F.xxhash64(*identity), F.lit(1 << 20)) / float((1 << 20) - 1)
    return F.round(fraction * F.lit(jitter * 1_000_000)).cast("long")


def request_wait(requests: DataFrame, robots_source: DataFrame, config: PolitenessConfig) -> DataFrame:
    """Add ``wait_us``: time from arrival to the request leaving both gates."""
    scheduled = crawl_delay_schedule(requests, robots_source, config)
    extra = jitter_us(config.jitter, F.col("req_id"))
    return scheduled.withColumn("wait_us", F.col("final_us") - F.col("arrival_us") + extra)


def trailing_counts(requests: DataFrame, per_domain: bool = False) -> DataFrame:
    """Requests in the second up to and including each request's time.

    A request counts from its time until just after one second later, so the
    count is a running total of entries minus exits. A request without a time
    keeps its row, with a null count.
    """
    keys = ["domain"] if per_domain else []
    requests = _keyed(requests) if per_domain else requests
    timed = requests.where(F.col("arrival_us").isNotNull())
    came = timed.select(*keys, F.col("arrival_us").alias("at_us"), F.lit(1).alias("d"))
    left = timed.select(*keys, (F.col("arrival_us") + TRAILING_US + 1).alias("at_us"), F.lit(-1).alias("d"))
    level = running_total(came.unionByName(left), keys, "at_us", F.col("d"), "trailing")
    return requests.join(level.withColumnRenamed("at_us", "arrival_us"), [*keys, "arrival_us"], "left")


def trailing_count_at(requests: DataFrame, now_us: Column) -> DataFrame:
    """The same count for one instant: a filtered aggregate."""
    age = now_us - F.col("arrival_us")
    return requests.agg(F.count_if((age >= 0) & (age <= TRAILING_US)).alias("trailing"))


def rate_stats(waits: DataFrame, config: PolitenessConfig, blocked: DataFrame, backoffs: DataFrame) -> DataFrame:
    """One row: rates, average delay, blocked and backoff counts, total requests.

    The trailing count is taken at the log's last request. Averages are whole
    microseconds summed, so they do not depend on row order. The three logs are
    tagged and aggregated together, which needs no join.
    """
    now_us = waits.agg(F.max("arrival_us")).first()[0] or 0
    none = F.lit(None).cast("long")
    tagged = (
        waits.select(F.lit("request").alias("tag"), "arrival_us", "wait_us")
        .unionByName(blocked.select("url").distinct().select(F.lit("blocked").alias("tag"), none.alias("arrival_us"), none.alias("wait_us")))
        .unionByName(backoffs.select(F.lit("backoff").alias("tag"), none.alias("arrival_us"), none.alias("wait_us")))
    )
    row = tagged.agg(
        F.count_if(F.col("arrival_us") >= now_us - TRAILING_US).alias("current_requests_per_second"),
        F.coalesce(F.sum("wait_us"), F.lit(0)).alias("_wait"),
        F.count_if(F.col("tag") == "blocked").alias("blocked_by_robots"),
        F.count_if(F.col("tag") == "request").alias("total_requests"),
        F.count_if(F.col("tag") == "backoff").alias("backoff_count"),
    )
    average = F.when(F.col("total_requests") > 0, F.col("_wait") / F.col("total_requests") / 1_000_000).otherwise(0.0)
    return row.select(
        F.lit(float(config.requests_per_second)).alias("requests_per_second"),
        F.lit(float(config.effective_rps)).alias("effective_requests_per_second"),
        "current_requests_per_second",
        average.alias("average_delay"),
        "blocked_by_robots",
        "total_requests",
        "backoff_count",
    )


def concurrency_profile(requests: DataFrame, per_domain: bool = False) -> DataFrame:
    """Active requests after each instant something started or ended, from
    [arrival_us, end_us) intervals."""
    keys = ["domain"] if per_domain else []
    timed = (_keyed(requests, UNKNOWN_KEY) if per_domain else requests).where(F.col("end_us") > F.col("arrival_us"))
    starts = timed.select(*keys, F.col("arrival_us").alias("at_us"), F.lit(1).alias("d"))
    ends = timed.select(*keys, F.col("end_us").alias("at_us"), F.lit(-1).alias("d"))
    return running_total(starts.unionByName(ends), keys, "at_us", F.col("d"), "active")


def concurrency_peaks(requests: DataFrame) -> DataFrame:
    """Peak of active requests per domain."""
    return concurrency_profile(requests, per_domain=True).groupBy("domain").agg(F.max("active").alias("peak"))


def domain_waves(requests: DataFrame, max_per_domain: int = 2) -> DataFrame:
    """Add ``wave``: at most ``max_per_domain`` requests of a domain per wave."""
    at_least("max_per_domain", max_per_domain, 1)
    placed = ordinals(_keyed(requests), ["domain"], ORDER, "_i")
    return placed.withColumn("wave", F.floor(F.col("_i") / max_per_domain).cast("long")).drop("_i")

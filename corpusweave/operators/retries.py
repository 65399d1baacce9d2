"""Error classification, retry replay and error reports over attempt logs.

An attempt log is (url, attempt, status, kind, cause): ``kind`` is one of http,
timeout, network, response_error, empty, parse; ``cause`` names the original
exception where there was one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.config import RetryConfig, SimpleBackoffConfig, TimeoutConfig
from corpusweave.functions.binding import settled
from corpusweave.functions.html import FETCH_FAILED
from corpusweave.sources.sinks import Entries, json_object, json_text

# Status sets, message texts and the type hierarchy.
TRANSIENT_STATUSES = (408, 425, 429, 500, 502, 503, 504)
PERMANENT_STATUSES = (400, 401, 403, 404, 405, 410)
TIMEOUT_MESSAGE = "Timeout while loading URL"
NETWORK_MESSAGE = "Network error while loading URL"
RESPONSE_MESSAGE = "HTTP client response error"
EMPTY_MESSAGE = "Request returned empty or failed result"
PARENT_TYPES = ("CrawlerError", "Exception")


def status_error(status: Column) -> Column:
    """(type, message) for an HTTP status, NULL when it is no error."""

    def verdict(kind: str, label: str) -> Column:
        return F.struct(F.lit(kind).alias("type"), F.concat(F.lit(label + " HTTP error: "), status.cast("string")).alias("message"))

    return (
        F.when(status.isin(*TRANSIENT_STATUSES), verdict("TransientError", "Transient"))
        .when(status >= 500, verdict("TransientError", "Server"))
        .when(status.isin(*PERMANENT_STATUSES), verdict("PermanentError", "Permanent"))
        .when(status.between(400, 499), verdict("PermanentError", "Client"))
    )


def _fixed(kind: str, message: str) -> Column:
    return F.struct(F.lit(kind).alias("type"), F.lit(message).alias("message"))


def classified(attempts: DataFrame) -> DataFrame:
    """Add error_type, error_base (message without context), error_status and
    error_cause; all NULL on success."""
    status, kind = F.col("status"), F.col("kind")
    by_status = status_error(status)
    answered = kind.isin("http", "response_error")
    error = (
        F.when(answered & by_status.isNotNull(), by_status)
        .when(kind == "response_error", _fixed("NetworkError", RESPONSE_MESSAGE))
        .when(kind == "timeout", _fixed("TransientError", TIMEOUT_MESSAGE))
        .when(kind == "network", _fixed("NetworkError", NETWORK_MESSAGE))
        .when(kind == "parse", _fixed("ParseError", ""))
        .when(kind == "empty", _fixed("TransientError", EMPTY_MESSAGE))
    )
    wrapped = kind.isin("timeout", "network") | ((kind == "response_error") & by_status.isNull())
    return (
        settled(attempts, "_e", error)
        .withColumn("error_type", F.col("_e.type"))
        .withColumn("error_base", F.col("_e.message"))
        .withColumn("error_status", F.when(answered & F.col("_e").isNotNull(), status))
        .withColumn("error_cause", F.when(wrapped, F.col("cause")))
        .drop("_e")
    )


def error_message(error_type: Column, base: Column, url: Column, status: Column, cause: Column) -> Column:
    """Message with its context, absent parts left out."""
    head = F.when(F.coalesce(base, F.lit("")) == "", error_type).otherwise(base)
    return F.concat_ws(
        " | ",
        head,
        F.concat(F.lit("url="), url),
        F.concat(F.lit("status_code="), status.cast("string")),
        F.concat(F.lit("original_error="), cause),
    )


def with_message(errors: DataFrame) -> DataFrame:
    text = error_message(*(F.col(c) for c in ("error_type", "error_base", "url", "error_status", "error_cause")))
    return errors.withColumn("message", F.when(F.col("error_type").isNotNull(), text))


def lineage(error_type: Column) -> Column:
    return F.when(error_type.isNotNull(), F.array_distinct(F.array(error_type, *(F.lit(p) for p in PARENT_TYPES))))


def is_retryable(error_type: Column, config: RetryConfig) -> Column:
    if not config.retry_on:
        return F.lit(False)
    wanted = F.array(*(F.lit(t) for t in config.retry_on))
    return F.coalesce(F.arrays_overlap(lineage(error_type), wanted), F.lit(False))


def _first_match(error_type: Column, table: dict, default) -> Column:
    chosen = None
    for name, value in table.items():
        test = F.array_contains(lineage(error_type), name)
        chosen = F.when(test, F.lit(value)) if chosen is None else chosen.when(test, F.lit(value))
    return F.lit(default) if chosen is None else chosen.otherwise(F.lit(default))


def retry_limit(error_type: Column, config: RetryConfig) -> Column:
    return _first_match(error_type, config.retry_limits, config.max_retries)


def retry_delay(error_type: Column, attempt: Column, config: RetryConfig) -> Column:
    """base_delay times the error's factor to the attempt, in seconds."""
    factor = _first_match(error_type, {k: float(v) for k, v in config.backoff_by_error.items()}, float(config.backoff_factor))
    return F.lit(float(config.base_delay)) * F.pow(factor, attempt.cast("double"))


def replay(attempts: DataFrame, config: RetryConfig) -> DataFrame:
    """Attempts that run under a policy, with how each URL ends.

    A URL stops at its first attempt that succeeds, is not retryable, has
    reached its error's limit, or is the last allowed; a shorter log is
    ``pending``. Later attempts never run, so they are dropped first and no URL
    keeps more than ``max_retries + 1`` rows.
    """
    log = classified(attempts.where(F.col("attempt") <= config.max_retries))
    e, a = F.col("error_type"), F.col("attempt")
    log = log.withColumn("retryable", is_retryable(e, config)).withColumn("retry_limit", retry_limit(e, config))
    last = (e.isNull()) | ~F.col("retryable") | (a >= F.col("retry_limit")) | (a == config.max_retries)
    stops = log.groupBy("url").agg(F.min(F.when(last, a)).alias("stop"))
    ran = log.join(stops, "url").where(F.col("stop").isNull() | (a <= F.col("stop")))
    delayed = e.isNotNull() & F.col("retryable") & (a < F.col("retry_limit"))
    final = a == F.col("stop")
    return (
        ran.withColumn("retry_delay", F.when(delayed, retry_delay(e, a, config)))
        .withColumn(
            "outcome",
            F.when(F.col("stop").isNull(), "pending").when(final & e.isNull(), "success").when(final, "failed").otherwise("retried"),
        )
        .drop("stop")
    )


def error_history(replayed: DataFrame) -> DataFrame:
    """One row per URL that ended in an error, with the attempt that did."""
    return with_message(replayed.where(F.col("outcome") == "failed")).select(
        "url", "attempt", F.col("error_type").alias("type"), "message", F.col("error_status").alias("status_code")
    )


def permanent_errors(history: DataFrame, order: str = "attempt") -> DataFrame:
    """url to message for permanent errors; the latest by ``order`` wins."""
    rows = history.where(F.col("type") == "PermanentError")
    return rows.groupBy("url").agg(F.max_by("message", order).alias("message"))


def error_stats(replayed: DataFrame, config: RetryConfig) -> DataFrame:
    """One row of counters. Delays are summed as whole nanoseconds."""
    e = F.col("error_type")
    nanos = F.round(F.col("retry_delay") * 1_000_000_000).cast("decimal(38,0)")
    gave_up = (F.col("outcome") == "failed") & F.col("retryable") & (F.col("attempt") >= F.col("retry_limit"))
    counters = [F.count_if(e == t).alias(t) for t in ("TransientError", "PermanentError", "NetworkError", "ParseError")]
    row = replayed.agg(
        *counters,
        F.count_if((F.col("outcome") == "success") & (F.col("attempt") > 0)).alias("successful_retries"),
        F.count_if(gave_up).alias("failed_after_retries"),
        F.coalesce(F.sum(nanos), F.lit(0)).cast("double").alias("_delay"),
        F.count("retry_delay").alias("_delays"),
        F.count("error_type").alias("total_error_events"),
        F.count_if(F.col("outcome") == "failed").alias("final_failures"),
        F.count_if((F.col("outcome") == "failed") & (e == "PermanentError")).alias("permanent_error_urls"),
    )
    mean = F.when(F.col("_delays") > 0, F.col("_delay") / F.col("_delays") / 1e9).otherwise(0.0)
    return row.withColumn("average_retry_delay", mean).drop("_delay", "_delays")


def simple_backoff(attempts: DataFrame, config: SimpleBackoffConfig) -> DataFrame:
    """Replay of the plain policy: any failure is retried, doubling the wait.
    ``backoff`` is NULL where no wait followed."""
    log = classified(attempts.where(F.col("attempt") <= config.max_retries))
    e, a = F.col("error_type"), F.col("attempt")
    stops = log.groupBy("url").agg(F.min(F.when(e.isNull() | (a >= config.max_retries), a)).alias("stop"))
    ran = log.join(stops, "url").where(F.col("stop").isNull() | (a <= F.col("stop")))
    waits = e.isNotNull() & (a < config.max_retries) & F.lit(config.backoff_base > 0)
    delay = F.lit(float(config.backoff_base)) * F.pow(F.lit(2.0), a.cast("double"))
    if config.jitter > 0:
        fraction = F.pmod(F.xxhash64("url", "attempt"), F.lit(1 << 20)) / float((1 << 20) - 1)
        delay = delay + fraction * config.jitter
    return ran.select("url", "attempt", "error_type", F.when(waits, delay).alias("backoff"))


def timeouts(attempts: DataFrame, config: TimeoutConfig) -> DataFrame:
    """Add total, connect and read timeouts, growing with the attempt; NULL
    when no total timeout is set."""
    if config.total_timeout is None:
        nothing = F.lit(None).cast("double")
        return attempts.withColumns({"total": nothing, "connect": nothing, "read": nothing})
    growth = F.pow(F.lit(float(config.timeout_backoff_factor)), F.col("attempt").cast("double"))
    return attempts.withColumns(
        {
            "total": F.lit(float(config.total_timeout)) * growth,
            "connect": F.lit(float(config.connect_timeout)) * growth,
            "read": F.lit(float(config.read_timeout)) * growth,
        }
    )


def error_report(replayed: DataFrame, config: RetryConfig) -> DataFrame:
    """Report as rows (section, body): one JSON object per entry.

    The counters are one line; history, permanent errors and delays are one
    line per entry, so a report over any number of failures stays distributed.
    """
    stats = error_stats(replayed, config)
    history = error_history(replayed)
    line = lambda section, df: df.select(F.lit(section).alias("section"), F.to_json(F.struct(*df.columns)).alias("body"))
    delays = replayed.where(F.col("retry_delay").isNotNull()).select("url", "attempt", "retry_delay")
    return (
        line("error_stats", stats)
        .unionByName(line("error_history", history))
        .unionByName(line("permanent_errors", permanent_errors(history)))
        .unionByName(line("retry_delays", delays))
    )


def error_document(replayed: DataFrame, config: RetryConfig) -> dict:
    """The report as one nested document for ``sinks.write_document``: counters are
    read once, every list and mapping over URLs stays a table."""
    counts = error_stats(replayed, config).first().asDict()
    history = error_history(replayed)
    permanent = permanent_errors(history)
    delays = replayed.where(F.col("retry_delay").isNotNull())
    types = ("TransientError", "PermanentError", "NetworkError", "ParseError")
    stats = {
        "errors_by_type": {t: counts[t] for t in types if counts[t]},
        **{name: counts[name] for name in ("successful_retries", "failed_after_retries", "average_retry_delay")},
        "permanent_error_urls": Entries(permanent, json_text(F.col("url")), ("url",)),
        **{name: counts[name] for name in ("total_error_events", "final_failures")},
    }
    return {
        "error_stats": stats,
        "error_history": Entries(history, json_object("url", "type", "message", "status_code"), ("url", "attempt")),
        "permanent_errors": Entries(permanent, json_text(F.col("message")), ("url",), key=F.col("url")),
        "retry_delays": Entries(delays, F.col("retry_delay").cast("string"), ("url", "attempt")),
    }


def crawl_document(replayed: DataFrame, config: RetryConfig, rate_stats: dict) -> dict:
    """The whole run: rate statistics, error report, and what became of each URL."""
    by_outcome = lambda outcome: replayed.where(F.col("outcome") == outcome).select("url").distinct()
    calls = replayed.groupBy("url").agg(F.count("*").alias("n"))
    return {
        "rate_stats": rate_stats,
        "error_report": error_document(replayed, config),
        "processed_urls": Entries(by_outcome("success"), json_text(F.col("url")), ("url",)),
        "failed_urls": Entries(by_outcome("failed"), json_text(F.lit(FETCH_FAILED)), ("url",), key=F.col("url")),
        "http_calls": Entries(calls, F.col("n").cast("string"), ("url",), key=F.col("url")),
    }

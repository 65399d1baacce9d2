"""Structured Streaming forms of the live crawl state.

Each job takes a request stream (see ``sources.tables.with_requests``). The
``run_*`` drivers process what is available and return the written result; a
service would use the same jobs with another trigger. Watermarks are an
addition of ours: rows later than one are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.functions import urls as U
from corpusweave.operators.politeness import TRAILING_US, trailing_counts
from corpusweave.operators.retries import classified
from corpusweave.operators.scans import fifo_gate
from corpusweave.session import run_dir, written
from corpusweave.sources.tables import with_requests

def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_requests(event_stream(spark, sf_dir))


def visited_once(stream: DataFrame, horizon: str | None = None, time_column: str = "ts") -> DataFrame:
    """Pass each normalised URL once: for good, or within ``horizon``."""
    urls = stream.withColumn("url", U.normalize(F.col("url")))
    if horizon is None:
        return urls.dropDuplicates(["url"])
    return urls.withWatermark(time_column, horizon).dropDuplicatesWithinWatermark(["url"])


SALTS = 16


def visited_urls(stream: DataFrame, horizon: str | None = None, time_column: str = "ts") -> DataFrame:
    """The visited set as bare URLs; with ``horizon`` a URL is forgotten after that
    long, and the state holds no more than it saw in that time.

    Repeats go in two keyed steps: by URL and a salt first, so that one very frequent
    URL is spread over ``SALTS`` tasks and sends at most so many rows to the second.
    """
    urls = stream.withColumn("url", U.normalize(F.col("url"))).withColumn("_salt", F.pmod(F.xxhash64("req_id"), F.lit(SALTS)))
    if horizon is None:
        return urls.select("url", "_salt").dropDuplicates(["url", "_salt"]).select("url").dropDuplicates(["url"])
    timed = urls.select("url", "_salt", time_column).withWatermark(time_column, horizon)
    return timed.dropDuplicatesWithinWatermark(["url", "_salt"]).dropDuplicatesWithinWatermark(["url"]).select("url")


def request_rate(stream: DataFrame, per_domain: bool = True, window: str = "1 second", slide: str | None = None, lateness: str = "1 minute") -> DataFrame:
    timed = stream.withColumn("ts", F.timestamp_micros("arrival_us")).withWatermark("ts", lateness)
    span = F.window("ts", window, slide) if slide else F.window("ts", window)
    keys = [F.col("domain")] if per_domain else []
    return timed.groupBy(span, *keys).agg(F.count("*").alias("n"))


def error_counts(stream: DataFrame) -> DataFrame:
    return classified(stream).where(F.col("error_type").isNotNull()).groupBy("error_type").agg(F.count("*").alias("n"))


def _finish(writer, checkpoint: str) -> None:
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _batch_writer(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # A batch that is run again writes the same folder again.
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def run_visited(stream: DataFrame, horizon: str | None = None) -> DataFrame:
    spark = stream.sparkSession
    out = run_dir(spark, "visited")
    unique = visited_urls(stream, horizon)
    _finish(unique.writeStream.format("parquet").option("path", f"{out}/data").outputMode("append"), f"{out}/checkpoint")
    return spark.read.schema(unique.schema).parquet(f"{out}/data")


def run_request_rate(stream: DataFrame, per_domain: bool = True) -> DataFrame:
    """Latest count per window, from updates written batch by batch."""
    spark = stream.sparkSession
    out = run_dir(spark, "rate")
    rate = request_rate(stream, per_domain)
    _finish(rate.writeStream.outputMode("update").foreachBatch(_batch_writer(f"{out}/data")), f"{out}/checkpoint")
    keys = ["window", *(["domain"] if per_domain else [])]
    written = spark.read.parquet(f"{out}/data")
    latest = written.groupBy(*keys).agg(F.max_by("n", "batch_id").alias("n"))
    return latest.select(F.unix_micros("window.start").alias("window_us"), *keys[1:], "n")


def run_error_counts(stream: DataFrame) -> DataFrame:
    spark = stream.sparkSession
    out = run_dir(spark, "errors")
    counts = error_counts(stream)
    _finish(counts.writeStream.outputMode("update").foreachBatch(_batch_writer(f"{out}/data")), f"{out}/checkpoint")
    written = spark.read.parquet(f"{out}/data")
    return written.groupBy("error_type").agg(F.max_by("n", "batch_id").alias("n"))


def run_schedule(stream: DataFrame, interval_us: int) -> DataFrame:
    """Polite scheduler: one state value per domain, its last start.

    Every micro-batch is gated with the batch form, carrying each domain's last
    start in; a hot domain is scanned in ranges like any other. The state table
    of batch n is derived from that of n-1, so a repeated batch is harmless.
    """
    spark = stream.sparkSession
    out = run_dir(spark, "schedule")

    def gate(batch: DataFrame, batch_id: int) -> None:
        here = batch.sparkSession
        rows = batch.select("req_id", "domain", "arrival_us")
        if batch_id > 0:
            state = here.read.parquet(f"{out}/state/batch_id={batch_id - 1}")
        else:
            state = here.createDataFrame([], "domain string, last_us long")
        carried = rows.join(state, "domain", "left")
        gated = fifo_gate(carried, ["domain"], ["arrival_us", "req_id"], "arrival_us", F.lit(interval_us), "start_us", last="last_us")
        gated.drop("last_us").write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")
        done = here.read.parquet(f"{out}/data/batch_id={batch_id}")
        merged = state.union(done.select("domain", F.col("start_us").alias("last_us")))
        merged.groupBy("domain").agg(F.max("last_us").alias("last_us")).write.mode("overwrite").parquet(
            f"{out}/state/batch_id={batch_id}"
        )

    _finish(stream.writeStream.foreachBatch(gate), f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/data").drop("batch_id")


def run_trailing(stream: DataFrame, lateness_us: int = 60_000_000, per_domain: bool = False) -> DataFrame:
    """Requests in the second up to and including each request's time, live.

    A request is counted when no more than ``lateness_us`` can be missing before
    it; what comes later than that is dropped. The state is the requests of the
    lateness and one second more, whatever the stream's length, and each batch is
    counted with the batch form, so a busy second is scanned in ranges. Batch n's
    state is derived from that of n-1, so a repeated batch is harmless.
    """
    spark = stream.sparkSession
    out = run_dir(spark, "trailing")
    columns = "req_id long, domain string, arrival_us long, counted boolean"

    def newest(rows: DataFrame) -> int | None:
        return rows.agg(F.max("arrival_us")).first()[0]

    def counts(held: DataFrame, until: Column) -> DataFrame:
        wanted = ~F.col("counted") & until
        return trailing_counts(held, per_domain).where(wanted).select("req_id", "domain", "arrival_us", "trailing")

    def step(batch: DataFrame, batch_id: int) -> None:
        here = batch.sparkSession
        state = here.createDataFrame([], columns)
        if batch_id > 0:
            state = here.read.schema(columns).parquet(f"{out}/state/batch_id={batch_id - 1}")
        before = newest(state)
        rows = batch.where("arrival_us is not null").select("req_id", "domain", "arrival_us", F.lit(False).alias("counted"))
        if before is not None:
            rows = rows.where(F.col("arrival_us") > before - lateness_us)
        held = written(state.unionByName(rows), "trailing-held")
        last = newest(held)
        safe = (last if last is not None else 0) - lateness_us
        done = F.col("arrival_us") <= safe
        counts(held, done).write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")
        kept = held.where(F.col("arrival_us") > safe - TRAILING_US).withColumn("counted", F.col("counted") | done)
        kept.write.mode("overwrite").parquet(f"{out}/state/batch_id={batch_id}")

    _finish(stream.writeStream.foreachBatch(step), f"{out}/checkpoint")
    states = spark.read.option("basePath", f"{out}/state").parquet(f"{out}/state")
    rest = states.where(F.col("batch_id") == states.agg(F.max("batch_id")).first()[0]).drop("batch_id")
    done = spark.read.parquet(f"{out}/data").drop("batch_id")
    return done.unionByName(counts(rest, F.lit(True)))

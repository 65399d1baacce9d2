"""Bounded breadth-first crawl over an archived link graph.

The visit order of a breadth-first crawl is (depth, least position path), where
a path is the seed's index followed by link positions. One join per level finds
the next URLs. A page's rank in its level and a link's position stand in one long,
which orders the links as their paths do: its minimum per URL both removes
duplicates and fixes the order, in a hash aggregate, and ranks the next level.
Paths are put together once per URL. Whether a URL may be crawled is asked of the
distinct URLs found, not of every link. Levels are written, so a plan never grows
with depth.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.config import CrawlConfig
from corpusweave.functions import html as H
from corpusweave.functions import urls as U
from corpusweave.functions.binding import let, settled
from corpusweave.operators import extract as X
from corpusweave.operators import frontier as FR
from corpusweave.operators import robots as R
from corpusweave.operators.scans import ordinals
from corpusweave.session import checkpointed, written

# A frontier up to this measured size is broadcast to the edges; a larger one is
# joined by a shuffle. The rows are the same.
SMALL_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class LinkGraph:
    """``edges(src, pos, dst)`` between normalised URLs, and ``corpus(url)``
    with the URLs whose body is present."""

    edges: DataFrame
    corpus: DataFrame


def link_graph(pages: DataFrame) -> LinkGraph:
    """Graph of a page table. Several page URLs may normalise to one key; the
    lowest page_id stands for it, chosen on narrow columns before any body is
    touched. Links resolve against the normalised URL, on the pruned page."""
    keyed = settled(pages, "_key", U.normalize(F.col("url")))
    chosen = keyed.groupBy("_key").agg(F.min("page_id").alias("page_id")).select("page_id")
    staged = keyed.select("page_id", F.col("_key").alias("src"), F.col("html"))
    links = let(H.pruned(F.col("html")), lambda p: U.normalize_each(X.link_array(p, F.col("src"))))
    # Bodies stay where they were read: only links and keys are shuffled.
    narrow = settled(staged.where(F.length("html") > 0), "links", links).select("page_id", "src", "links")
    kept = narrow.join(chosen, "page_id", "left_semi")
    edges = kept.select("src", F.posexplode("links").alias("pos", "dst"))
    corpus = keyed.where(F.length("html") > 0).select("page_id", F.col("_key").alias("url")).join(chosen, "page_id", "left_semi")
    return LinkGraph(edges, corpus.select("url"))


def seeds_from(spark: SparkSession, start_urls: list[str]) -> DataFrame:
    """(seq, url) from a start list in its order."""
    return spark.createDataFrame(list(enumerate(start_urls)), "seq long, url string")


def _seed_frontier(seeds: DataFrame, domains: DataFrame | None, config: CrawlConfig) -> DataFrame:
    candidates = FR.crawlable(
        FR.normalized(seeds.select("seq", "url")), None, domains, config.exclude_patterns, config.include_patterns
    )
    first = candidates.groupBy("url").agg(F.min("seq").cast("int").alias("seq"))
    return first.select(
        "url", F.array("seq").alias("path"), F.lit(None).cast("string").alias("discoverer"), F.col("seq").cast("long").alias("_key")
    )


def _outcome(level: DataFrame, small: bool, corpus: DataFrame, rules: DataFrame | None, config: CrawlConfig) -> DataFrame:
    if small:
        corpus = corpus.join(F.broadcast(level.select("url")), "url", "left_semi")
    present = corpus.select("url", F.lit(True).alias("_present"))
    known = level.join(present, "url", "left")
    if rules is not None:
        known = R.with_verdict(known, rules)
    else:
        known = known.withColumn("allowed", F.lit(True))
    reason = (
        F.when(~F.col("allowed"), F.lit(R.BLOCK_REASON + config.user_agent))
        .when(F.col("_present").isNull(), F.lit(H.FETCH_FAILED))
        .otherwise("")
    )
    status = F.when(~F.col("allowed"), "blocked").when(F.col("_present").isNull(), "failed").otherwise("processed")
    return known.withColumn("status", status).withColumn("reason", reason).drop("_present", "allowed")


def _small(frontier: DataFrame) -> tuple[int, bool]:
    """Rows of a written frontier, and whether its URLs and keys may be broadcast."""
    row = frontier.agg(F.count("*"), F.sum(F.octet_length("url") + 32)).first()
    return row[0], (row[1] or 0) <= SMALL_BYTES


def _links(open_pages: DataFrame, small: bool, edges: DataFrame) -> DataFrame:
    """Links of ``open_pages(src, ...)``. Pages of one site begin alike, so a shuffled
    join sorts by a hash before it compares URLs."""
    if small:
        return edges.join(F.broadcast(open_pages), "src")
    hashed = lambda df: df.withColumn("_hash", F.hash("src"))
    return hashed(edges).join(hashed(open_pages), ["_hash", "src"]).drop("_hash")


# A key is a page's rank in its level, below 2^32, and a link's position.
POSITION_BITS = 31


def _found(level: DataFrame, small: bool, edges: DataFrame) -> DataFrame:
    """``(url, _key)``: the least key of each URL that a level's processed pages link to."""
    open_pages = level.where(F.col("status") == "processed").select(F.col("url").alias("src"), "_rank")
    key = F.shiftleft("_rank", POSITION_BITS).bitwiseOR(F.col("pos").cast("long"))
    reached = _links(open_pages, small, edges).select(F.col("dst").alias("url"), key.alias("_key"))
    return reached.groupBy("url").agg(F.min("_key").alias("_key"))


def _placed(frontier: DataFrame, level: DataFrame, small: bool) -> DataFrame:
    """Paths and discoverers of a frontier found from ``level``."""
    above = level.select(F.col("_rank").alias("_above"), F.col("path").alias("_path"), F.col("url").alias("discoverer"))
    if small:
        above = F.broadcast(above)
    pos = F.col("_key").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")
    of = frontier.withColumn("_above", F.shiftright("_key", POSITION_BITS))
    return of.join(above, "_above").withColumn("path", F.concat("_path", F.array(pos))).drop("_above", "_path")


def _least_paths(visited: DataFrame, small: bool, edges: DataFrame) -> DataFrame:
    """``(url, path)``: the least path of each URL that processed pages of any level link to."""
    open_pages = visited.where(F.col("status") == "processed").select(F.col("url").alias("src"), "path")
    path = F.concat("path", F.array(F.col("pos").cast("int"))).alias("path")
    return _links(open_pages, small, edges).select(F.col("dst").alias("url"), path).groupBy("url").agg(F.min("path").alias("path"))


def crawl(
    seeds: DataFrame, graph: LinkGraph, config: CrawlConfig, robots_source: DataFrame | None = None,
    include_queued: bool = False,
) -> DataFrame:
    """Crawl outcome (url, depth, path, discoverer, status, reason).

    ``seeds`` is (seq, url). Only processed pages contribute links, and only
    down to ``max_depth``. ``max_pages`` counts processed, failed and blocked
    URLs. With ``include_queued`` the URLs that were enqueued and never visited
    follow with status ``queued``.
    """
    domains = written(FR.seed_domains(seeds), "domains") if config.same_domain_only else None
    crawlable = lambda found: FR.crawlable(found, None, domains, config.exclude_patterns, config.include_patterns)
    # No level follows the last one: a crawl of depth 0 needs no links.
    edges = written(graph.edges.select("src", "pos", "dst"), "edges") if config.max_depth > 0 else graph.edges
    corpus = written(graph.corpus.distinct(), "corpus")
    rules = None
    if robots_source is not None and config.respect_robots:
        rules = checkpointed(R.rules_for_agent(robots_source, config.user_agent))
    seed_frontier = _seed_frontier(seeds, domains, config)
    frontier = written(seed_frontier, "frontier")
    visited: DataFrame | None = None
    above, few_above, n_visited = None, True, 0
    for depth in range(config.max_depth + 1):
        n_level, small = _small(frontier)
        ranked = ordinals(frontier, [], ["_key", "url"], "_rank")
        if config.max_pages is not None:
            left = config.max_pages - n_visited
            ranked, n_level = ranked.where(F.col("_rank") < left), min(n_level, left)
            small = small or n_level * 1024 <= SMALL_BYTES
        placed = ranked if above is None else _placed(ranked, above, few_above)
        level = written(_outcome(placed.withColumn("depth", F.lit(depth)), small, corpus, rules, config), "level")
        visited = level if visited is None else visited.unionByName(level)
        n_visited += n_level
        spent = config.max_pages is not None and n_visited >= config.max_pages
        if n_level == 0 or depth == config.max_depth or spent:
            break
        # Written before it is filtered, or the filters would run on every link below the aggregate.
        found = written(FR.unknown_only(_found(level, small, edges), visited), "found")
        frontier = written(crawlable(found), "frontier")
        above, few_above = level, small
    out = visited.select("url", "depth", "path", "discoverer", "status", "reason")
    if not include_queued:
        return out
    inner = out.where(F.col("depth") < config.max_depth)
    n_bytes = inner.agg(F.sum(F.octet_length("url") + 4 * F.size("path") + 32)).first()[0] or 0
    reached = crawlable(_least_paths(inner, n_bytes <= SMALL_BYTES, edges)).unionByName(seed_frontier.select("url", "path"))
    queued = FR.unknown_only(reached.groupBy("url").agg(F.min("path").alias("path")), out)
    return out.unionByName(
        queued.select(
            "url", (F.size("path") - 1).alias("depth"), "path", F.lit(None).cast("string").alias("discoverer"),
            F.lit("queued").alias("status"), F.lit("").alias("reason"),
        )
    )


def visit_order(crawled: DataFrame) -> DataFrame:
    """Add ``visit_order``: the position in which each URL was visited."""
    return ordinals(crawled, [], ["depth", "path"], "visit_order")


def discovered_counts(crawled: DataFrame) -> DataFrame:
    """Links each page was the first to enqueue."""
    return crawled.where(F.col("discoverer").isNotNull()).groupBy(F.col("discoverer").alias("url")).agg(F.count("*").alias("added"))


def progress(crawled: DataFrame, requests: DataFrame) -> DataFrame:
    """One row of crawl metrics. Elapsed time and active requests come from the
    request log, at its last arrival; both logs are tagged and aggregated once."""
    span = requests.agg(F.min("arrival_us"), F.max("arrival_us")).first()
    first_us, now_us = (span[0] or 0), (span[1] or 0)
    active: Column = (F.col("arrival_us") <= now_us) & (F.col("end_us") > now_us)
    rows = crawled.select("status", F.lit(0).alias("is_active")).unionByName(
        requests.select(F.lit("request").alias("status"), active.cast("int").alias("is_active"))
    )
    counted = rows.agg(
        *(F.count_if(F.col("status") == s).alias(s) for s in ("processed", "queued", "failed", "blocked")),
        F.coalesce(F.sum("is_active"), F.lit(0)).alias("active"),
    )
    elapsed_us = max(now_us - first_us, 1)
    done = F.col("processed") + F.col("failed") + F.col("blocked")
    return counted.withColumn("elapsed_us", F.lit(elapsed_us).cast("long")).withColumn(
        "pages_per_second", done * F.lit(1_000_000.0) / F.lit(float(elapsed_us))
    )

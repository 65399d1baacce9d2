import random

import pytest

from corpusweave.config import CrawlConfig
from corpusweave.operators import frontier as FR
from corpusweave.operators import robots as R
from corpusweave.plans import crawl as C
from corpusweave.sources import tables as T

SITE = "https://library.example"
# Two ways to one book, a way back to the door, a page that names itself, one that is lost.
PAGES = {
    "/": '<a href="shelf/b">b</a><a href="/shelf/a">a</a><a href="/shelf/b#top">b</a><a href="//press.example/n">n</a>',
    "/shelf/a": '<a href="/book/3#c">3</a><a href="/">door</a>',
    "/shelf/b": '<a href="../book/3">3</a><a href="/book/1?x=1">1</a>',
    "/book/3": '<a href="">again</a><a href="3">again</a>',
    "/book/1?x=1": '<a href="/lost">lost</a>',
}


@pytest.fixture(scope="module")
def site(spark):
    rows = [(i, SITE + p, h) for i, (p, h) in enumerate(PAGES.items())]
    return C.link_graph(spark.createDataFrame(rows, "page_id long, url string, html string"))


def seeds(spark, *urls):
    return C.seeds_from(spark, list(urls))


def run(spark, graph, config, *urls, **kw):
    crawled = C.crawl(seeds(spark, *urls), graph, config, **kw)
    rows = C.visit_order(crawled.where("status <> 'queued'")).orderBy("visit_order").collect()
    return [(r.url.replace(SITE, ""), r.depth, r.status) for r in rows]


def test_levels_follow_the_shortest_way(spark, site):
    got = run(spark, site, CrawlConfig(max_depth=3, same_domain_only=True), SITE)
    assert got == [
        ("/", 0, "processed"), ("/shelf/b", 1, "processed"), ("/shelf/a", 1, "processed"), ("/book/3", 2, "processed"),
        ("/book/1?x=1", 2, "processed"), ("/lost", 3, "failed"),
    ]


@pytest.mark.parametrize("pages", [1, 2, 4, 5])
def test_budget_ends_within_a_level(spark, site, pages):
    want = ["/", "/shelf/b", "/shelf/a", "/book/3", "/book/1?x=1"][:pages]
    assert [u for u, *_ in run(spark, site, CrawlConfig(max_depth=2, max_pages=pages, same_domain_only=True), SITE)] == want


def test_depth_counts_from_each_seed(spark, site):
    assert run(spark, site, CrawlConfig(max_depth=0), SITE + "/book/3", SITE) == [("/book/3", 0, "processed"), ("/", 0, "processed")]
    got = run(spark, site, CrawlConfig(max_depth=1, same_domain_only=True), SITE + "/book/1?x=1", SITE + "/shelf/a")
    assert got == [
        ("/book/1?x=1", 0, "processed"), ("/shelf/a", 0, "processed"), ("/lost", 1, "failed"), ("/book/3", 1, "processed"), ("/", 1, "processed"),
    ]


def test_pages_elsewhere_are_tried_unless_kept_out(spark, site):
    assert ("https://press.example/n", 1, "failed") in run(spark, site, CrawlConfig(max_depth=1), SITE)
    assert len(run(spark, site, CrawlConfig(max_depth=1, same_domain_only=True), SITE)) == 3


def test_patterns_and_bad_seeds(spark, site):
    config = CrawlConfig(max_depth=2, exclude_patterns=(r"/shelf/b$", r"press"), include_patterns=(r"library\.example/",))
    got = run(spark, site, config, SITE + "/shelf/b", SITE, "tel:5", "shelf/a", "")
    assert got == [("/", 0, "processed"), ("/shelf/a", 1, "processed"), ("/book/3", 2, "processed")]
    assert run(spark, site, CrawlConfig(), "tel:5", "shelf/a") == []


def test_robots_leave_the_other_way(spark, site):
    files = spark.createDataFrame([(SITE, 200, "User-agent: *\nDisallow: /shelf/b")], "base_url string, status int, body string")
    sources = R.robots_source(seeds(spark, SITE), files)
    config = CrawlConfig(max_depth=2, same_domain_only=True, user_agent="B/1")
    crawled = C.crawl(seeds(spark, SITE), site, config, sources)
    got = {r.url.replace(SITE, ""): (r.status, r.reason) for r in crawled.collect()}
    done = ("processed", "")
    assert got == {"/": done, "/shelf/b": ("blocked", "Blocked by robots.txt for user-agent B/1"), "/shelf/a": done, "/book/3": done}
    careless = C.crawl(seeds(spark, SITE), site, CrawlConfig(max_depth=2, same_domain_only=True, respect_robots=False), sources)
    assert careless.where("status = 'blocked'").count() == 0 and careless.count() == 5
    assert FR.queue_stats(crawled).first().asDict() == {"queued": 0, "processed": 3, "failed": 1, "total_known": 4}


def test_pages_that_share_a_key(spark):
    rows = [(5, "https://e.com/#b", '<a href="/late">x</a>'), (2, "https://E.com", '<a href="/first">x</a>'), (7, "https://e.com/empty", "")]
    graph = C.link_graph(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert [(r.src, r.dst) for r in graph.edges.collect()] == [("https://e.com/", "https://e.com/first")]
    assert [r.url for r in graph.corpus.collect()] == ["https://e.com/"]


def python_crawl(graph, present, start, max_depth, budget, batch):
    """Sequential crawl with a first-in-first-out queue and batches."""
    queue, known, visited, added = [], {}, [], {}
    for u in start:
        if u not in known:
            known[u] = 0
            queue.append(u)
    while len(visited) < budget:
        now = [queue.pop(0) for _ in range(min(batch, len(queue), budget - len(visited)))]
        if not now:
            break
        visited += now
        for u in now:
            if u in present and known[u] < max_depth:
                for v in graph.get(u, []):
                    if v not in known:
                        known[v] = known[u] + 1
                        added[u] = added.get(u, 0) + 1
                        queue.append(v)
    return [(u, known[u]) for u in visited], set(queue), added


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs_equal_a_sequential_crawl(spark, seed, monkeypatch):
    rng = random.Random(seed)
    names = [f"https://g.com/{i}" for i in range(30)]
    graph = {u: [rng.choice(names) for _ in range(rng.randint(0, 5))] for u in names}
    present = {u for u in names if rng.random() < 0.8}
    start = [rng.choice(names) for _ in range(3)]
    budget, depth = rng.choice([5, 12, 100]), rng.choice([1, 3, 5])
    edges = spark.createDataFrame([(u, i, v) for u, vs in graph.items() for i, v in enumerate(vs)], "src string, pos int, dst string")
    corpus = spark.createDataFrame([(u,) for u in present], "url string")
    if seed % 2:  # the ways taken by large frontiers and budgets
        monkeypatch.setattr(C, "SMALL_BYTES", 0)
    config = CrawlConfig(max_depth=depth, max_pages=budget)
    crawled = C.crawl(seeds(spark, *start), C.LinkGraph(edges, corpus), config, include_queued=True)
    rows = crawled.collect()
    want, queued, added = python_crawl(graph, present, start, depth, budget, rng.choice([1, 4, 10]))
    order = sorted((r for r in rows if r.status != "queued"), key=lambda r: (r.depth, r.path))
    assert [(r.url, r.depth) for r in order] == want
    assert {r.url for r in rows if r.status == "queued"} == queued
    assert {r.status for r in order if r.url in present} <= {"processed"}
    if budget == 100:
        assert {r.url: r.added for r in C.discovered_counts(crawled).collect()} == added


def test_progress(spark, site):
    crawled = C.crawl(seeds(spark, SITE), site, CrawlConfig(max_depth=3, same_domain_only=True))
    log = spark.createDataFrame([(0, 10), (2_000_000, 2_500_000)], "arrival_us long, end_us long")
    assert C.progress(crawled, log).first().asDict() == {
        "processed": 5, "queued": 0, "failed": 1, "blocked": 0, "active": 1, "elapsed_us": 2_000_000, "pages_per_second": 3.0,
    }


def test_frontier_keeps_the_first_arrival(spark):
    rows = [(9, "https://e.com/quiet", 3, 4), (4, "https://e.com/loud", 8, 1), (5, "https://e.com/loud", -1, 0), (6, "", 9, 0), (7, "https://e.com/even", 3, 2),
            (2, "https://e.com/met", 70, 0), (8, "https://e.com/quiet", 2, 7)]
    queue = spark.createDataFrame(rows, "seq int, url string, priority int, depth int")
    frontier = FR.frontier_merge(queue, spark.createDataFrame([("https://e.com/met",)], "url string"))
    assert [(r.url[14:], r.priority) for r in FR.frontier_topk(frontier, 9).collect()] == [("loud", 8), ("even", 3), ("quiet", 2)]
    wanted = spark.createDataFrame([("https://e.com/quiet",), ("https://e.com/met",)], "url string")
    assert {r.url[14:]: r.depth for r in FR.depth_lookup(wanted, frontier).collect()} == {"quiet": 7, "met": 0}


def test_state_keeps_the_latest_reason_and_both_sets(spark):
    events = spark.createDataFrame(
        [("u", "failed", "timeout", 1), ("u", "failed", "503", 2), ("u", "processed", "", 3), ("v", "processed", "", 1)],
        "url string, state string, reason string, seq int",
    )
    got = {(r.url, r.state): r.reason for r in FR.url_state(events).collect()}
    assert got == {("u", "failed"): "503", ("u", "processed"): "", ("v", "processed"): ""}


def test_filters(spark):
    urls = FR.normalized(spark.createDataFrame([("https://Example.com/about",), ("https://external.com/p",), ("mailto:a@b",), ("https://example.com/seen#x",)], "url string"))
    domains = FR.seed_domains(seeds(spark, "https://example.com", "mailto:t@e.com", "/rel"))
    known = spark.createDataFrame([("https://example.com/seen",)], "url string")
    assert [r.domain for r in domains.collect()] == ["example.com"]
    assert [r.url for r in FR.crawlable(urls, known, domains).collect()] == ["https://example.com/about"]
    assert FR.crawlable(urls).count() == 3


def test_levels_reduce_links_by_hash_and_filter_distinct_urls(spark, monkeypatch):
    level = spark.createDataFrame([("https://g.com/a", "processed", 0), ("https://g.com/b", "processed", 1), ("https://g.com/c", "failed", 2)], "url string, status string, _rank long")
    links = [("https://g.com/b", 0, "https://g.com/x"), ("https://g.com/a", 7, "https://g.com/x"), ("https://g.com/b", 1, "https://g.com/y"), ("https://g.com/c", 0, "https://g.com/z")]
    found = C._found(level, False, spark.createDataFrame(links, "src string, pos int, dst string"))
    assert {r.url[-1]: (r._key >> C.POSITION_BITS, r._key % (1 << C.POSITION_BITS)) for r in found.collect()} == {"x": (0, 7), "y": (1, 1)}
    assert "SortAggregate" not in found._jdf.queryExecution().toString()
    asked, crawlable = [], FR.crawlable
    monkeypatch.setattr(C.FR, "crawlable", lambda urls, *rest: asked.append(urls) or crawlable(urls, *rest))
    many = spark.createDataFrame([("https://g.com/a", i, f"https://g.com/{i % 2}") for i in range(40)], "src string, pos int, dst string")
    crawled = C.crawl(seeds(spark, "https://g.com/a"), C.LinkGraph(many, spark.createDataFrame([("https://g.com/a",)], "url string")), CrawlConfig(max_depth=1))
    assert crawled.count() == 3 and [a.count() for a in asked] == [1, 2]


def test_star_links_count_from_zero_per_page_without_a_sort_by_range(spark, tmp_path):
    rows = {
        "nation": ([(0, 0), (1, 0)], "n_nationkey long, n_regionkey long"),
        "customer": ([(5, 1), (3, 1), (3, 1)], "c_custkey long, c_nationkey long"),
        "supplier": ([(2, 1)], "s_suppkey long, s_nationkey long"),
        "orders": ([(9, 3), (8, 3), (None, 3)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(8, 4, 2), (8, 4, 2), (8, 1, 2), (9, 4, None)], "l_orderkey long, l_partkey long, l_suppkey long"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    links = T.star_links(spark, str(tmp_path))
    got = sorted((r.of, -1 if r.key is None else r.key, r.pos, r.kind, r.k) for r in links.collect())  # no two agree in the first three
    assert got == [
        (0, 0, 0, 1, 0), (0, 0, 1, 1, 1), (1, 1, 0, 2, 3), (1, 1, 1, 2, 3), (1, 1, 2, 2, 5), (1, 1, 3, 3, 2),
        (2, 3, 0, 4, None), (2, 3, 1, 4, 8), (2, 3, 2, 4, 9), (3, -1, 0, 5, 4), (3, 2, 0, 5, 1), (3, 2, 1, 5, 4),
        (4, 8, 0, 6, 1), (4, 8, 1, 6, 4), (4, 9, 0, 6, 4),
    ]
    assert "rangepartitioning" not in links._jdf.queryExecution().toString()

import random
from urllib.robotparser import RobotFileParser

import pytest

from corpusweave.operators import robots as R

SITE = "https://example.com"


def source(spark, *bodies):
    files = [(f"https://h{i}.com", 200, b) for i, b in enumerate(bodies)]
    urls = spark.createDataFrame([(f"{b}/x",) for b, _, _ in files], "url string")
    return R.robots_source(urls, spark.createDataFrame(files, "base_url string, status int, body string"))


def decisions(spark, body, agent, *paths):
    urls = spark.createDataFrame([(f"https://h0.com{p}",) for p in paths], "url string")
    got = {r.url[len("https://h0.com"):]: r.allowed for r in R.with_allowed(urls, source(spark, body), agent).collect()}
    return [got[p] for p in paths]


# Worked by hand: (file, agent, delay).
DELAYS = [
    ("User-agent: crane\nCrawl-delay: 7", "Crane/9", 7.0),
    ("User-agent: crane\nCrawl-delay: 7", "heron", 0.0),
    ("User-agent: crane\n\nCrawl-delay: 7", "crane", 0.0),  # the empty line ends the group
    ("User-agent: crane\n# quiet\nCrawl-delay: 7", "crane", 0.0),  # a line that is only a comment does too
    ("User-agent: crane\nUser-agent: heron\nCrawl-delay: 3", "heron/2", 3.0),
    ("User-agent: crane\nDisallow: /x\nUser-agent: heron\nCrawl-delay: 3", "crane", 0.0),  # a rule closes the list of agents
    ("User-agent: crane\nCrawl-delay: 2\nCrawl-delay: 4", "crane", 4.0),
    ("User-agent: crane\nCrawl-delay: 2\nCrawl-delay: -4\nCrawl-delay: fast", "crane", 2.0),
    ("user-AGENT : Crane # bird\ncrawl-DELAY : .5 # s", "crane", 0.5),
    ("User-agent: *\nCrawl-delay: 9\n\nUser-agent: crane\nCrawl-delay: 1", "stork", 9.0),
    ("User-agent: *\nCrawl-delay: 9\n\nUser-agent: crane\nCrawl-delay: 1", "big-crane-bot", 1.0),
    ("User-agent: crane\nCrawl-delay: 1\n\nUser-agent: crane-bot\nCrawl-delay: 6", "crane-bot", 6.0),  # the whole name first
    ("Crawl-delay: 5\nUser-agent: *\nCrawl-delay: 8", "any", 8.0),
    ("User-agent:\nCrawl-delay: 5", "any", 0.0),
]


def test_delays_worked_by_hand(spark):
    for agent in sorted({a for _, a, _ in DELAYS}):
        cases = [(body, want) for body, a, want in DELAYS if a == agent]
        got = {r.base_url: r.delay for r in R.delay_for_agent(source(spark, *(b for b, _ in cases)), agent).collect()}
        assert got == {f"https://h{i}.com": want for i, (_, want) in enumerate(cases)}, agent


def test_decisions_worked_by_hand(spark):
    body = "User-agent: heron\nAllow: /nest/eggs\nDisallow: /nest\n\nUser-agent: *\nDisallow: /reeds\n"
    assert decisions(spark, body, "heron", "/nest/eggs/1", "/nest/young", "/reeds") == [True, False, True]
    assert decisions(spark, body, "*", "/nest", "/reeds/a", "/open") == [True, False, True]


@pytest.mark.parametrize(("status", "body"), [(404, "User-agent: *\nDisallow: /"), (None, "User-agent: *\nDisallow: /"), (200, None)])
def test_unavailable_robots_allow(spark, status, body):
    urls = spark.createDataFrame([(f"{SITE}/private/page",)], "url string")
    files = spark.createDataFrame([(SITE, status, body)], "base_url string, status int, body string")
    src = R.robots_source(urls, files)
    assert src.first().available is False
    assert R.with_allowed(urls, src, "*").first().allowed is True
    assert R.delay_for_agent(src, "*").first().delay == 0.0


def test_one_lookup_per_site(spark):
    urls = spark.createDataFrame([(f"{SITE}/page-1",), ("HTTPS://Example.com/page-2",), ("https://python.org/p",)], "url string")
    files = spark.createDataFrame([(SITE, 200, "x")], "base_url string, status int, body string")
    got = {r.base_url: r.robots_url for r in R.robots_source(urls, files).collect()}
    assert got == {SITE: SITE + "/robots.txt", "https://python.org": "https://python.org/robots.txt"}


def test_blocked_reason_and_switch(spark):
    src = source(spark, "User-agent: *\nDisallow: /no")
    urls = spark.createDataFrame([("https://h0.com/no/1",), ("https://h0.com/yes",)], "url string")
    assert [tuple(r) for r in R.robots_blocked(urls, src, "B/1").collect()] == [("https://h0.com/no/1", "Blocked by robots.txt for user-agent B/1")]
    assert R.robots_blocked(urls, src, "B/1", respect_robots=False).count() == 0


def test_random_files_equal_the_sequential_readings(spark):
    rng = random.Random(3)
    lines = [
        "", " ", "# note", "  # pause", "User-agent: *", "User-agent: Bot", "user-agent : bot2 # c", "User-agent:", "Agent: x", "no colon",
        "Disallow: /a", "Disallow:", "Allow: /a/b", "Allow:", "Disallow: /*", "Disallow: *", "Disallow: /%61?", "Disallow: /q?x=1", "Allow: /%2Fz",
        "Crawl-delay: 1", "Crawl-delay: 2.5", "Crawl-delay: -1", "Crawl-delay: soon", "Request-rate: 1/5", "Sitemap: /s", "Disallow: /",
    ]
    ends = ["\n", "\r\n", "\r", "\n", "\n"]
    bodies = ["".join(rng.choice(lines) + rng.choice(ends) for _ in range(rng.randint(0, 14))) for _ in range(250)]
    src = source(spark, *bodies)
    paths = ["/", "", "/a", "/a/b/c", "/ab", "/q?x=1&y", "/q", "/%61/b", "//z", "/b#f"]
    urls = spark.createDataFrame([(f"https://h{i}.com{p}",) for i in range(len(bodies)) for p in paths], "url string")
    for agent in ("Bot/1.0", "other", "*", "bot2"):
        got = {r.url: r.allowed for r in R.with_allowed(urls, src, agent).collect()}
        for i, body in enumerate(bodies):
            model = RobotFileParser()
            model.parse(body.splitlines())
            for p in paths:
                if p == "//z":
                    continue
                url = f"https://h{i}.com{p}"
                assert got[url] == model.can_fetch(agent, url), (body, agent, p)

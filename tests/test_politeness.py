import random

import pytest
from pyspark.sql import functions as F

from corpusweave.config import PolitenessConfig
from corpusweave.operators import politeness as P
from corpusweave.plans import queries as Q
from corpusweave.operators import robots as R
from corpusweave.operators import scans


def log(spark, rng, n=400, domains=("a", "b", "hot", "hot", "hot")):
    rows, t = [], 0
    for i in range(n):
        t += rng.choice([0, 0, 1, 200_000, 900_000, 5_000_000])
        d = rng.choice(domains)
        rows.append((i, f"https://{d}.com/{i}", f"{d}.com", t, t + rng.choice([0, 1, 400_000, 3_000_000])))
    return rows, spark.createDataFrame(rows, "req_id long, url string, domain string, arrival_us long, end_us long").repartition(5)


def sequential(rows, key, ready, gap, last=None):
    last = dict(last or {})
    out = {}
    for row in sorted(rows, key=lambda r: (ready(r), r[0])):
        k = key(row)
        start = ready(row) if k not in last else max(ready(row), last[k] + gap(row))
        last[k] = out[row[0]] = start
    return out


@pytest.mark.parametrize("per_domain", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_rate_schedule_equals_a_loop(spark, per_domain, seed):
    rows, df = log(spark, random.Random(seed))
    config = PolitenessConfig(requests_per_second=2.0, per_domain=per_domain)
    got = {r.req_id: r.start_us for r in P.rate_schedule(df, config).collect()}
    assert got == sequential(rows, lambda r: r[2] if per_domain else "", lambda r: r[3], lambda r: 500_000)


def test_spacing_and_independence(spark):
    df = spark.createDataFrame([(1, "", "a", 0), (2, "", "a", 0), (3, "", "a", 0), (4, "", "b", 0), (5, "", None, 0), (6, "", "", 0)],
                               "req_id long, url string, domain string, arrival_us long")
    got = {r.req_id: r.start_us for r in P.rate_schedule(df, PolitenessConfig(requests_per_second=20)).collect()}
    assert got == {1: 0, 2: 50_000, 3: 100_000, 4: 0, 5: 0, 6: 50_000}
    one = {r.req_id: r.start_us for r in P.rate_schedule(df, PolitenessConfig(requests_per_second=1, per_domain=False)).collect()}
    assert one == {i: (i - 1) * 1_000_000 for i in range(1, 7)}


def test_crawl_delay_equals_a_loop(spark):
    rows, df = log(spark, random.Random(5))
    files = spark.createDataFrame(
        [("https://hot.com", 200, "User-agent: *\nCrawl-delay: 1.5"), ("https://a.com", 200, "User-agent: *\nCrawl-delay: 0")],
        "base_url string, status int, body string",
    )
    config = PolitenessConfig(requests_per_second=4.0)
    waits = P.request_wait(df, R.robots_source(df.select("url"), files), config)
    first = sequential(rows, lambda r: r[2], lambda r: r[3], lambda r: 250_000)
    hot = [r for r in rows if r[2] == "hot.com"]
    final = {**first, **sequential(hot, lambda r: r[2], lambda r: first[r[0]], lambda r: 1_500_000)}
    got = {r.req_id: (r.final_us, r.wait_us) for r in waits.collect()}
    assert got == {r[0]: (final[r[0]], final[r[0]] - r[3]) for r in rows}
    off = P.crawl_delay_schedule(df, R.robots_source(df.select("url"), files), PolitenessConfig(4.0, respect_robots=False))
    assert off.where("final_us <> start_us").count() == 0


def test_jitter_is_bounded_and_repeatable(spark):
    df = spark.range(500).select(P.jitter_us(0.2, F.col("id")).alias("j"))
    values = [r.j for r in df.collect()]
    assert 0 <= min(values) and max(values) <= 200_000 and len(set(values)) > 400
    assert values == [r.j for r in df.collect()]


@pytest.mark.parametrize("per_domain", [True, False])
def test_trailing_counts_equal_brute_force(spark, per_domain):
    rows, df = log(spark, random.Random(9), 300)
    got = {r.req_id: r.trailing for r in P.trailing_counts(df, per_domain).collect()}
    for r in rows:
        near = [x for x in rows if r[3] - 1_000_000 <= x[3] <= r[3] and (not per_domain or x[2] == r[2])]
        assert got[r[0]] == len(near)
    now = rows[-1][3]
    assert P.trailing_count_at(df, F.lit(now)).first().trailing == len([x for x in rows if now - 1_000_000 <= x[3]])


def test_concurrency_equals_brute_force(spark):
    rows, df = log(spark, random.Random(11), 300)
    got = {r.at_us: r.active for r in P.concurrency_profile(df).collect()}
    for at, active in got.items():
        assert active == len([r for r in rows if r[3] <= at < r[4]])
    peaks = {r.domain: r.peak for r in P.concurrency_peaks(df).collect()}
    for d in peaks:
        times = [r[3] for r in rows if r[2] == d]
        assert peaks[d] == max(len([r for r in rows if r[2] == d and r[3] <= t < r[4]]) for t in times)


def test_waves_hold_at_most_the_limit(spark):
    rows, df = log(spark, random.Random(13))
    waves = P.domain_waves(df, 3)
    for r in waves.groupBy("domain", "wave").count().collect():
        assert r["count"] <= 3
    order = {}
    want = {}
    for r in sorted(rows, key=lambda r: (r[3], r[0])):
        want[r[0]] = order.get(r[2], 0) // 3
        order[r[2]] = order.get(r[2], 0) + 1
    assert {r.req_id: r.wave for r in waves.collect()} == want
    with pytest.raises(ValueError):
        P.domain_waves(df, 0)


def test_rate_stats(spark):
    waits = spark.createDataFrame([(0, 0), (500_000, 250_000), (1_500_000, 750_000)], "arrival_us long, wait_us long")
    blocked = spark.createDataFrame([("u",), ("u",)], "url string")
    backoffs = spark.createDataFrame([(0.5,)], "backoff double")
    config = PolitenessConfig(requests_per_second=5.0, min_delay=0.5)
    assert P.rate_stats(waits, config, blocked, backoffs).first().asDict() == {
        "requests_per_second": 5.0, "effective_requests_per_second": 2.0, "current_requests_per_second": 2,
        "average_delay": 1 / 3, "blocked_by_robots": 1, "total_requests": 3, "backoff_count": 1,
    }
    empty = P.rate_stats(waits.limit(0), config, blocked.limit(0), backoffs.limit(0)).first()
    assert (empty.average_delay, empty.total_requests, empty.current_requests_per_second) == (0.0, 0, 0)


def test_ordinals_over_a_hot_key(spark):
    df = spark.range(5000).select((F.col("id") % 7 > 3).alias("k"), "id")
    got = scans.ordinals(df, ["k"], ["id"], "i").orderBy("k", "id").collect()
    for key in (False, True):
        assert [r.i for r in got if r.k == key] == list(range(len([r for r in got if r.k == key])))


def test_rates_between_microseconds_do_not_drift(spark):
    log = spark.range(3001).select(F.col("id").alias("req_id"), F.lit("d").alias("domain"), F.lit(0).cast("long").alias("arrival_us"))
    last = P.rate_schedule(log, PolitenessConfig(requests_per_second=3)).agg(F.max("start_us")).first()[0]
    assert abs(last - 1_000_000_000) <= 2
    fast = P.rate_schedule(log, PolitenessConfig(requests_per_second=4_000_000)).agg(F.max("start_us")).first()[0]
    assert fast == 750


def test_requests_without_a_time_keep_their_row(spark):
    log = spark.createDataFrame([(1, "d", 10), (2, "d", None), (3, "d", 10)], "req_id long, domain string, arrival_us long")
    got = {r.req_id: r.trailing for r in P.trailing_counts(log).collect()}
    assert got == {1: 2, 2: None, 3: 2}


def test_positions_of_rows_without_a_key(spark):
    from corpusweave.operators.scans import ordinals

    log = spark.range(4000).select(F.col("id"), F.lit(None).cast("string").alias("key"))
    assert sorted(r.at for r in ordinals(log, ["key"], ["id"], "at").collect()) == list(range(4000))


def test_rate_stats_query_makes_the_sites_once(spark, tmp_path, monkeypatch):
    events = spark.sql("select id as event_id, timestamp_seconds(id * 40000) as ts, id % 3 as user_id, 'view' as event_type, 2.5D as value, concat('{\"k\": ', id * 7, '}') as props from range(12)")
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.sql("select 1L as page_id, 'https://a.example.com/en/1' as url, '<p>x' as html").write.parquet(f"{tmp_path}/pages.parquet")
    made, source = [], Q.R.robots_source
    monkeypatch.setattr(Q.R, "robots_source", lambda *a: made.append(1) or source(*a))
    row = Q.rate_stats(spark, str(tmp_path)).first()
    assert (len(made), row.total_requests) == (1, 12)

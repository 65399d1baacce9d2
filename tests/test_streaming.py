import random

import pytest
from pyspark.sql import functions as F

from corpusweave.streaming import jobs as S

SCHEMA = "req_id long, url string, domain string, arrival_us long, status int, kind string, cause string"


def files(spark, path, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/b{i}")
    return (
        spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(str(path))
    )


@pytest.fixture(scope="module")
def batches():
    rng, t, out = random.Random(21), 1_700_000_000_000_000, []
    for b in range(3):
        rows = []
        for i in range(60):
            t += rng.choice([0, 1000, 300_000, 2_000_000])
            d = rng.choice(["a.com", "b.com", "hot.com", "hot.com"])
            rows.append((b * 100 + i, f"https://{d}/{rng.randint(0, 9)}#f{i}", d, t, rng.choice([200, 404, 503]), "http", None))
        out.append(rows)
    return out


def test_schedule_carries_state_over_batches(spark, tmp_path, batches):
    got = {r.req_id: r.start_us for r in S.run_schedule(files(spark, tmp_path, batches), 1_000_000).collect()}
    last, want = {}, {}
    for r in sorted((r for b in batches for r in b), key=lambda r: (r[3], r[0])):
        last[r[2]] = want[r[0]] = max(r[3], last[r[2]] + 1_000_000) if r[2] in last else r[3]
    assert got == want


def test_visited_passes_each_url_once(spark, tmp_path, batches):
    got = [r.url for r in S.run_visited(files(spark, tmp_path, batches)).collect()]
    assert sorted(got) == sorted({r[1].split("#")[0] for b in batches for r in b})


def test_visited_needs_no_python_and_spreads_a_hot_url(spark, tmp_path, batches):
    hot = [[(k, "https://hot.com/", "hot.com", 1_700_000_000_000_000 + k, 200, "http", None) for k in range(900)]]
    stream = files(spark, tmp_path, hot)
    plan = S.visited_urls(stream)._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "InPandas" not in plan and plan.count("Deduplicate") == 2
    assert [r.url for r in S.run_visited(stream).collect()] == ["https://hot.com/"]


def test_visited_forgets_after_the_horizon(spark, tmp_path):
    at = lambda s: 1_700_000_000_000_000 + s * 1_000_000
    seen = [("a", 0), ("a", 30), ("b", 500), ("c", 1000), ("a", 1500)]
    rows = [[(k, f"https://{d}.com/", f"{d}.com", at(s), 200, "http", None)] for k, (d, s) in enumerate(seen)]
    stream = files(spark, tmp_path, rows).withColumn("ts", F.timestamp_micros("arrival_us"))
    got = sorted(r.url for r in S.run_visited(stream, "60 seconds").collect())
    assert got == ["https://a.com/", "https://a.com/", "https://b.com/", "https://c.com/"]


@pytest.mark.parametrize("per_domain", [True, False])
def test_rate_per_second(spark, tmp_path, batches, per_domain):
    got = {tuple(r[:-1]): r.n for r in S.run_request_rate(files(spark, tmp_path, batches), per_domain).collect()}
    want = {}
    for r in (r for b in batches for r in b):
        key = (r[3] // 1_000_000 * 1_000_000, *([r[2]] if per_domain else []))
        want[key] = want.get(key, 0) + 1
    assert got == want


@pytest.mark.parametrize("per_domain", [True, False])
def test_trailing_second_over_batches(spark, tmp_path, batches, per_domain):
    """Batches overlap by less than the lateness; equal instants meet across batches."""
    rows = sorted(((r[3] // 500_000 * 500_000, r) for b in batches for r in b), key=lambda x: x[0])
    mixed = [[(*r[:3], t, *r[4:]) for k, (t, r) in enumerate(rows) if (k + 7 * (k % 3)) // 40 == b] for b in range(6)]
    got = {r.req_id: r.trailing for r in S.run_trailing(files(spark, tmp_path, mixed), 60_000_000, per_domain).collect()}
    flat = [r for b in mixed for r in b]
    assert len(flat) == len(got) == 180
    near = lambda a, b: 0 <= a[3] - b[3] <= 1_000_000 and (not per_domain or a[2] == b[2])
    assert got == {a[0]: sum(near(a, b) for b in flat) for a in flat}


def test_trailing_state_is_bounded_and_late_rows_drop(spark, tmp_path):
    at = lambda s: 1_700_000_000_000_000 + s * 1_000_000
    times = [[0, 1], [100], [2, 50, 101], [102]]
    batches = [[(10 * b + k, "u", "d", at(s), 200, "http", None) for k, s in enumerate(ts)] for b, ts in enumerate(times)]
    got = {r.req_id: r.trailing for r in S.run_trailing(files(spark, tmp_path, batches), 60_000_000).collect()}
    assert got == {0: 1, 1: 2, 10: 1, 21: 1, 22: 2, 30: 2}  # 20 came later than the lateness allows


def test_error_counters(spark, tmp_path, batches):
    got = {r.error_type: r.n for r in S.run_error_counts(files(spark, tmp_path, batches)).collect()}
    rows = [r for b in batches for r in b]
    assert got == {"PermanentError": len([r for r in rows if r[4] == 404]), "TransientError": len([r for r in rows if r[4] == 503])}


def test_bounded_visited_set_plans(spark, tmp_path, batches):
    stream = files(spark, tmp_path, batches).withColumn("ts", F.timestamp_micros("arrival_us"))
    assert S.visited_once(stream, "10 minutes").isStreaming

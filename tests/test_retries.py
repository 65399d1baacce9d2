import json
import random

import pytest
from pyspark.sql import functions as F

from corpusweave.config import RetryConfig, SimpleBackoffConfig, TimeoutConfig
from corpusweave.operators import retries as RT
from corpusweave.sources import sinks

SCHEMA = "url string, attempt int, status int, kind string, cause string"
HTTP = lambda url, *codes: [(url, i, c, "http", None) for i, c in enumerate(codes)]


def log(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(
    ("status", "want"),
    [
        (503, ("TransientError", "Transient HTTP error: 503")), (429, ("TransientError", "Transient HTTP error: 429")),
        (599, ("TransientError", "Server HTTP error: 599")), (404, ("PermanentError", "Permanent HTTP error: 404")),
        (418, ("PermanentError", "Client HTTP error: 418")), (408, ("TransientError", "Transient HTTP error: 408")),
        (200, (None, None)), (304, (None, None)),
    ],
)
def test_status_classes(spark, status, want):
    row = RT.classified(log(spark, HTTP("u", status))).first()
    assert (row.error_type, row.error_base) == want


def test_messages(spark):
    rows = [
        ("u", 0, 404, "http", None), ("u", 1, None, "timeout", "TimeoutError"), ("u", 2, None, "network", "ClientError"),
        ("u", 3, 304, "response_error", "ClientResponseError"), ("u", 4, 200, "empty", None), ("u", 5, None, "parse", None),
        ("u", 6, 503, "response_error", "ClientResponseError"), ("u", 7, 200, "http", None),
    ]
    got = [(r.error_type, r.message) for r in RT.with_message(RT.classified(log(spark, rows))).orderBy("attempt").collect()]
    assert got == [
        ("PermanentError", "Permanent HTTP error: 404 | url=u | status_code=404"),
        ("TransientError", "Timeout while loading URL | url=u | original_error=TimeoutError"),
        ("NetworkError", "Network error while loading URL | url=u | original_error=ClientError"),
        ("NetworkError", "HTTP client response error | url=u | status_code=304 | original_error=ClientResponseError"),
        ("TransientError", "Request returned empty or failed result | url=u"),
        ("ParseError", "ParseError | url=u"),
        ("TransientError", "Transient HTTP error: 503 | url=u | status_code=503"),
        (None, None),
    ]


def delays(replayed):
    return [r.retry_delay for r in replayed.where("retry_delay is not null").orderBy("url", "attempt").collect()]


def test_delays_limits_and_factors(spark):
    net = [("u", i, None, "network", "E") for i in range(2)] + [("u", 2, 200, "http", None)]
    got = RT.replay(log(spark, net), RetryConfig(max_retries=3, base_delay=1.0, backoff_by_error={"NetworkError": 3.0}))
    assert delays(got) == [1.0, 3.0]
    limited = RT.replay(log(spark, HTTP("u", 503, 503, 503)), RetryConfig(max_retries=5, base_delay=0.1, retry_limits={"TransientError": 1}))
    assert delays(limited) == [0.1] and limited.count() == 2
    assert RT.error_stats(limited, RetryConfig()).first().failed_after_retries == 1
    parse = [("u", 0, None, "parse", None), ("u", 1, 200, "http", None)]
    assert RT.replay(log(spark, parse), RetryConfig()).count() == 1
    custom = RT.replay(log(spark, parse), RetryConfig(max_retries=1, retry_on=("ParseError",), base_delay=0.1))
    assert delays(custom) == [0.1] and RT.error_stats(custom, RetryConfig()).first().successful_retries == 1
    base = RT.replay(log(spark, HTTP("u", 404, 200)), RetryConfig(retry_on=("CrawlerError",)))
    assert base.count() == 2


def model(codes, config):
    """Sequential execution of one URL's attempts."""
    kinds = {503: "TransientError", 404: "PermanentError", -1: "NetworkError", -2: "ParseError"}
    ran, waits = [], []
    for a in range(config.max_retries + 1):
        if a >= len(codes):
            return ran, waits, "pending"
        error = kinds.get(codes[a])
        ran.append(error)
        if error is None:
            return ran, waits, "success"
        lineage = (error, "CrawlerError", "Exception")
        if not set(lineage) & set(config.retry_on):
            return ran, waits, "failed"
        limit = next((v for k, v in config.retry_limits.items() if k in lineage), config.max_retries)
        factor = next((v for k, v in config.backoff_by_error.items() if k in lineage), config.backoff_factor)
        if a >= limit:
            return ran, waits, "failed"
        waits.append(config.base_delay * factor**a)
    return ran, waits, "failed"


@pytest.mark.parametrize(
    "config",
    [
        RetryConfig(), RetryConfig(max_retries=2, retry_limits={"NetworkError": 0, "CrawlerError": 4}),
        RetryConfig(max_retries=4, retry_on=("TransientError", "ParseError"), backoff_by_error={"CrawlerError": 1.5}), RetryConfig(max_retries=0),
    ],
)
def test_replay_equals_a_sequential_model(spark, config):
    rng = random.Random(17)
    logs = {f"u{i}": [rng.choice([503, 503, 404, -1, -1, -2, 200]) for _ in range(rng.randint(1, 7))] for i in range(400)}
    rows = [
        (u, a, c if c > 0 else None, {-1: "network", -2: "parse"}.get(c, "http"), "E" if c == -1 else None)
        for u, codes in logs.items() for a, c in enumerate(codes)
    ]
    got = {}
    replayed = RT.replay(log(spark, rows), config)
    for r in replayed.orderBy("url", "attempt").collect():
        got.setdefault(r.url, []).append(r)
    for u, codes in logs.items():
        ran, waits, end = model(codes, config)
        assert [r.error_type for r in got[u]] == ran
        assert [r.retry_delay for r in got[u] if r.retry_delay is not None] == pytest.approx(waits)
        assert got[u][-1].outcome == end
    stats = RT.error_stats(replayed, config).first()
    ends = [(codes, *model(codes, config)) for codes in logs.values()]
    assert stats.total_error_events == sum(len([e for e in ran if e]) for _, ran, _, _ in ends)
    assert stats.final_failures == len([1 for *_, end in ends if end == "failed"])
    assert stats.successful_retries == len([1 for _, ran, _, end in ends if end == "success" and len(ran) > 1])


def harbour(spark):
    """Two URLs recover, one after a network error; one is refused for good, one never answers."""
    rows = HTTP("https://dock.example/a", 500, 502, 206) + HTTP("https://dock.example/gone", 410)
    rows += [("https://dock.example/b", 0, None, "network", "Reset"), ("https://dock.example/b", 1, 200, "http", None)]
    rows += [("https://dock.example/slow", i, None, "timeout", "TimeoutError") for i in range(3)]
    config = RetryConfig(max_retries=2, backoff_factor=3.0, base_delay=0.5)
    return RT.replay(log(spark, rows), config), config


def report(spark, tmp_path, replayed, config):
    sinks.write_report(RT.error_report(replayed, config), str(tmp_path / "r"))
    sections = {}
    for r in sinks.read_report(spark, str(tmp_path / "r")).collect():
        line = json.loads(r.value)
        sections.setdefault(line["section"], []).append(json.loads(line["body"]) if isinstance(line["body"], str) else line["body"])
    return sections


def test_written_report(spark, tmp_path):
    replayed, config = harbour(spark)
    got = report(spark, tmp_path, replayed, config)
    (stats,) = got["error_stats"]
    assert (stats["TransientError"], stats["PermanentError"], stats["NetworkError"]) == (5, 1, 1)
    assert (stats["successful_retries"], stats["total_error_events"], stats["final_failures"]) == (2, 7, 2)
    assert sorted(d["retry_delay"] for d in got["retry_delays"]) == pytest.approx([0.5, 0.5, 0.5, 1.5, 1.5])
    assert [p["url"] for p in got["permanent_errors"]] == ["https://dock.example/gone"]
    assert sorted(h["url"] for h in got["error_history"]) == ["https://dock.example/gone", "https://dock.example/slow"]


def test_nested_document(spark, tmp_path):
    replayed, config = harbour(spark)
    sinks.write_document(spark, RT.crawl_document(replayed, config, {"requests_per_second": 2.5, "note": 'q"\u00e9'}), str(tmp_path / "d"))
    sinks.join_document(spark, str(tmp_path / "d"), str(tmp_path / "whole.json"))
    got = json.loads((tmp_path / "whole.json").read_text())
    gone, slow = "https://dock.example/gone", "https://dock.example/slow"
    message = f"Permanent HTTP error: 410 | url={gone} | status_code=410"
    assert got["rate_stats"] == {"requests_per_second": 2.5, "note": 'q"\u00e9'}
    report = got["error_report"]
    assert report["error_stats"] == {
        "errors_by_type": {"TransientError": 5, "PermanentError": 1, "NetworkError": 1}, "successful_retries": 2, "failed_after_retries": 1,
        "average_retry_delay": pytest.approx(0.9), "permanent_error_urls": [gone], "total_error_events": 7, "final_failures": 2,
    }
    assert report["error_history"][0] == {"url": gone, "type": "PermanentError", "message": message, "status_code": 410}
    assert [(h["url"], h["status_code"]) for h in report["error_history"]] == [(gone, 410), (slow, None)]
    assert report["permanent_errors"] == {gone: message} and report["retry_delays"] == [0.5, 1.5, 0.5, 0.5, 1.5]
    assert got["processed_urls"] == ["https://dock.example/a", "https://dock.example/b"]
    assert got["failed_urls"] == dict.fromkeys([gone, slow], "Failed to fetch HTML")
    assert got["http_calls"] == {"https://dock.example/a": 3, "https://dock.example/b": 2, gone: 1, slow: 3}


def test_large_document_stays_in_parts(spark, tmp_path):
    rows = spark.range(50_000).select(F.concat(F.lit('u"\n'), F.lpad("id", 6, "0")).alias("url"), "id")
    document = {"none": sinks.Entries(rows.where("false"), F.col("id").cast("string"), ("id",)), "all": {"of": sinks.Entries(rows, F.col("id").cast("string"), ("url",), key=F.col("url"))}}
    sinks.write_document(spark, document, str(tmp_path / "d"))
    sinks.join_document(spark, str(tmp_path / "d"), str(tmp_path / "whole.json"))
    whole = json.loads((tmp_path / "whole.json").read_text())
    assert whole["none"] == [] and list(whole["all"]["of"].items()) == [(f'u"\n{k:06d}', k) for k in range(50_000)]
    assert sinks.read_entries(spark, str(tmp_path / "d"), "all.of").count() == 50_000
    assert sinks.read_entries(spark, str(tmp_path / "d"), "none").count() == 0


def test_no_errors(spark, tmp_path):
    got = report(spark, tmp_path, RT.replay(log(spark, HTTP("u", 200)), RetryConfig()), RetryConfig())
    (stats,) = got.pop("error_stats")
    assert stats["average_retry_delay"] == 0.0 and stats["final_failures"] == 0 and not any(got.values())


def test_the_latest_permanent_error_wins(spark):
    rows = [("u", 0, "PermanentError", "z first", 404), ("u", 2, "PermanentError", "a last", 410), ("u", 3, "NetworkError", "n", None)]
    history = spark.createDataFrame(rows, "url string, attempt int, type string, message string, status_code int")
    assert [tuple(r) for r in RT.permanent_errors(history).collect()] == [("u", "a last")]


def test_simple_backoff(spark):
    rows = HTTP("a", 404, 500, 200) + HTTP("b", 500, 500, 500, 200) + HTTP("c", 200)
    config = SimpleBackoffConfig(max_retries=2, backoff_base=0.5)
    got = [tuple(r) for r in RT.simple_backoff(log(spark, rows), config).select("url", "attempt", "backoff").orderBy("url", "attempt").collect()]
    assert got == [("a", 0, 0.5), ("a", 1, 1.0), ("a", 2, None), ("b", 0, 0.5), ("b", 1, 1.0), ("b", 2, None), ("c", 0, None)]
    none = RT.simple_backoff(log(spark, rows), SimpleBackoffConfig(2, 0.0))
    assert none.where("backoff is not null").count() == 0 and none.count() == 7


def test_timeouts_grow(spark):
    rows = log(spark, HTTP("u", 503, 503, 503)).select("url", "attempt")
    got = [(r.total, r.connect, r.read) for r in RT.timeouts(rows, TimeoutConfig(1.0)).orderBy("attempt").collect()]
    assert got == [(1.0, 5.0, 10.0), (2.0, 10.0, 20.0), (4.0, 20.0, 40.0)]
    assert RT.timeouts(rows, TimeoutConfig()).first().total is None

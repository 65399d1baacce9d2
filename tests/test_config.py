import pytest

from corpusweave.config import CrawlConfig, PolitenessConfig, RetryConfig, SimpleBackoffConfig, TimeoutConfig


@pytest.mark.parametrize(
    "make",
    [
        lambda: CrawlConfig(max_depth=-1), lambda: CrawlConfig(max_pages=0), lambda: CrawlConfig(max_concurrent=0),
        lambda: CrawlConfig(max_per_domain=0), lambda: PolitenessConfig(requests_per_second=0),
        lambda: PolitenessConfig(min_delay=-1), lambda: PolitenessConfig(jitter=-0.1), lambda: RetryConfig(max_retries=-1),
        lambda: RetryConfig(backoff_factor=-1), lambda: RetryConfig(base_delay=-1),
        lambda: RetryConfig(retry_limits={"TransientError": -1}), lambda: RetryConfig(backoff_by_error={"NetworkError": -1.0}),
        lambda: SimpleBackoffConfig(max_retries=-1), lambda: SimpleBackoffConfig(backoff_base=-1),
        lambda: TimeoutConfig(total_timeout=0), lambda: TimeoutConfig(timeout_backoff_factor=0.5),
    ],
)
def test_bad_values(make):
    with pytest.raises(ValueError):
        make()


def test_bad_error_types():
    with pytest.raises(TypeError):
        RetryConfig(retry_limits={"int": 1})


def test_effective_rate():
    assert PolitenessConfig(requests_per_second=100, min_delay=0.05).effective_rps == 20
    assert PolitenessConfig(requests_per_second=2, min_delay=0.05).effective_rps == 2
    assert PolitenessConfig(requests_per_second=20).interval_us == 50_000

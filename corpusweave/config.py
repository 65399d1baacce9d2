"""Validated parameters of the crawl, politeness and retry jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

# The default user agent, the error types a policy may name and, below, the defaults of each policy.
DEFAULT_USER_AGENT = "AsyncCrawler/1.0"
ERROR_TYPES = ("CrawlerError", "TransientError", "PermanentError", "NetworkError", "ParseError")


def at_least(name: str, value: float, low: float) -> None:
    if value < low:
        bound = "non-negative" if low == 0 else f"at least {low}"
        raise ValueError(f"{name} must be {bound}")


def _positive(name: str, value: float) -> None:
    if value <= 0:
        raise ValueError(f"{name} must be positive")


@dataclass(frozen=True)
class CrawlConfig:
    max_depth: int = 2
    max_pages: int | None = 100
    max_concurrent: int = 10
    max_per_domain: int = 2
    same_domain_only: bool = False
    exclude_patterns: tuple[str, ...] = ()
    include_patterns: tuple[str, ...] = ()
    respect_robots: bool = True
    user_agent: str = DEFAULT_USER_AGENT

    def __post_init__(self) -> None:
        at_least("max_depth", self.max_depth, 0)
        if self.max_pages is not None:
            at_least("max_pages", self.max_pages, 1)
        at_least("max_concurrent", self.max_concurrent, 1)
        at_least("max_per_domain", self.max_per_domain, 1)


@dataclass(frozen=True)
class PolitenessConfig:
    requests_per_second: float = 1.0
    min_delay: float = 0.0
    jitter: float = 0.0
    per_domain: bool = True
    respect_robots: bool = True
    user_agent: str = DEFAULT_USER_AGENT

    def __post_init__(self) -> None:
        _positive("requests_per_second", self.requests_per_second)
        at_least("min_delay", self.min_delay, 0)
        at_least("jitter", self.jitter, 0)

    @property
    def effective_rps(self) -> float:
        if self.min_delay > 0:
            return min(self.requests_per_second, 1.0 / self.min_delay)
        return self.requests_per_second

    @property
    def interval_us(self) -> int:
        return round(1_000_000 / self.effective_rps)

    @property
    def interval_ns(self) -> int:
        return round(1_000_000_000 / self.effective_rps)


@dataclass(frozen=True)
class RetryConfig:
    """``retry_limits`` and ``backoff_by_error`` are ordered: the first entry
    whose type is in an error's lineage applies."""

    max_retries: int = 3
    backoff_factor: float = 2.0
    base_delay: float = 1.0
    retry_on: tuple[str, ...] = ("TransientError", "NetworkError")
    retry_limits: dict[str, int] = field(default_factory=dict)
    backoff_by_error: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        at_least("max_retries", self.max_retries, 0)
        at_least("backoff_factor", self.backoff_factor, 0)
        at_least("base_delay", self.base_delay, 0)
        for label, table in (("retry_limits", self.retry_limits),
                             ("backoff_by_error", self.backoff_by_error)):
            for error_type, value in table.items():
                if error_type not in ERROR_TYPES and error_type != "Exception":
                    raise TypeError(f"{label} keys must be error types")
                at_least(f"{label} value", value, 0)


@dataclass(frozen=True)
class TimeoutConfig:
    total_timeout: float | None = None
    connect_timeout: float = 5.0
    read_timeout: float = 10.0
    timeout_backoff_factor: float = 2.0

    def __post_init__(self) -> None:
        if self.total_timeout is not None:
            _positive("total_timeout", self.total_timeout)
        at_least("timeout_backoff_factor", self.timeout_backoff_factor, 1)


@dataclass(frozen=True)
class SimpleBackoffConfig:
    max_retries: int = 2
    backoff_base: float = 0.5
    jitter: float = 0.0

    def __post_init__(self) -> None:
        at_least("max_retries", self.max_retries, 0)
        at_least("backoff_base", self.backoff_base, 0)
        at_least("jitter", self.jitter, 0)

"""Outcome column functions: U6 error class, U7 retryable flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: error classes and the retryable set
NETWORK = "NetworkError"
RATE_LIMIT = "RateLimitError"
TRANSIENT = "TransientError"
PERMANENT = "PermanentError"
RETRYABLE = (TRANSIENT, NETWORK, RATE_LIMIT)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def error_class(status) -> Column:
    """Status 0 (no HTTP answer) -> NetworkError; 429 -> RateLimitError;
    >= 500 -> TransientError; other 4xx -> PermanentError; below 400 -> null (ok)."""
    s = _c(status)
    return (F.when(s == 0, F.lit(NETWORK))
            .when(s == 429, F.lit(RATE_LIMIT))
            .when(s >= 500, F.lit(TRANSIENT))
            .when(s >= 400, F.lit(PERMANENT)))


def error_class_sql(status: str) -> str:
    return (f"CASE WHEN {status} = 0 THEN 'NetworkError' WHEN {status} = 429 THEN 'RateLimitError' "
            f"WHEN {status} >= 500 THEN 'TransientError' WHEN {status} >= 400 THEN 'PermanentError' END")


def is_retryable(error_type) -> Column:
    """A failure the retry loop tries again."""
    return F.coalesce(_c(error_type).isin(*RETRYABLE), F.lit(False))


def is_retryable_sql(error_type: str) -> str:
    return f"coalesce({error_type} IN ('TransientError', 'NetworkError', 'RateLimitError'), false)"


def counts_for_breaker(error_type) -> Column:
    """Failures the circuit breaker records: every failure but PermanentError."""
    e = _c(error_type)
    return e.isNotNull() & (e != PERMANENT)

"""Classes of provider errors, from their message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _has(c: Column, *parts: str) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(c, F.lit(p))
    return out


def _both(message: str | Column) -> tuple[Column, Column]:
    m = F.coalesce(F.col(message) if isinstance(message, str) else message, F.lit(""))
    return m, F.lower(m)


def rate_limited(message: str | Column) -> Column:
    return _has(_both(message)[1], "429", "quota", "resource_exhausted")


def daily_limited(message: str | Column) -> Column:
    return _has(_both(message)[1], "daily", "day", "user rate limit exceeded")


def schema_mismatch(message: str | Column) -> Column:
    m, low = _both(message)
    return _has(m, "ValidationError", "JSON") | _has(low, "parsing")


def retryable(message: str | Column) -> Column:
    return schema_mismatch(message) | _has(_both(message)[1], "timeout", "limit")


def too_many_tokens(message: str | Column) -> Column:
    low = _both(message)[1]
    return _has(low, "too many tokens", "split into more batches") | (_has(low, "400") & _has(low, "token"))


def error_class(message: str | Column) -> Column:
    """SCHEMA_MISMATCH, CONTEXT_EXCEEDED or API_ERROR, in this order."""
    low = _both(message)[1]
    context = _has(low, "too large", "context_length", "context length", "maximum context length", "400")
    return F.when(schema_mismatch(message), F.lit("SCHEMA_MISMATCH")).when(context, F.lit("CONTEXT_EXCEEDED")).otherwise(F.lit("API_ERROR"))

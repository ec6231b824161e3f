"""Vectors as arrays of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine of two vectors; 0 for a zero one, null for null, empty or differently long ones."""
    norm = F.sqrt(_total(a, a)) * F.sqrt(_total(b, b))
    return F.when((F.size(a) > 0) & (F.size(a) == F.size(b)), F.when(norm > 0, _total(a, b) / norm).otherwise(F.lit(0.0)))


def parse(c: str | Column) -> Column:
    """``"[a, b]"`` as an array of doubles; null where a part is no number, empty for ``"[]"``."""
    c = F.col(c) if isinstance(c, str) else c
    inner = F.regexp_replace(c, r"^\s*\[|\]\s*$", "")
    parts = F.when(F.trim(inner) == "", F.array().cast("array<double>")).otherwise(F.transform(F.split(inner, ","), lambda x: F.trim(x).try_cast("double")))
    return F.when(~F.exists(parts, lambda x: x.isNull()), parts)


def labelled(prefix: str, score: str | Column) -> Column:
    """``prefix:0.1234``."""
    return F.concat(F.lit(prefix + ":"), F.format_string("%.4f", score))

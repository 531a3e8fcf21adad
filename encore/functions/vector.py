"""Vector expressions evaluated with SQL higher-order functions (P10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of two equal-length DOUBLE arrays; NULL if either has zero length."""
    den = norm(a) * norm(b)
    return F.when(den > 0, dot(a, b) / den)


def rounded_similarity(a: Column, b: Column, digits: int = 6) -> Column:
    return F.round(cosine_similarity(a, b), digits)

"""Event weight, rec score and diversity expressions.

Weights are exact decimals, kept at precision 18 so Spark computes them on
longs; the trainer's are doubles, neither rounded nor refused by size. Sums of
either don't depend on the order rows arrive in: decimal sums, or exact sums
of doubles. A rec score is one
IEEE multiply of the exactly converted similarity and weight: max and top-N
on it are order independent, and the same two operations give the same bits
in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: weight of each start reason.
REASON_WEIGHTS = {
    "query": 10,
    "rec": 5,
    "browsing": 5,
    "radio": 3,
}

PLAYED_TYPE = "decimal(15,4)"
REASON_WEIGHT_TYPE = "decimal(2,0)"
SIMILARITY_TYPE = "decimal(8,6)"


def reason_weight(reason: Column) -> Column:
    """Weight of a start reason; NULL for an unknown reason (the row is dropped)."""
    expr = None
    for name, weight in REASON_WEIGHTS.items():
        cond = reason == F.lit(name)
        expr = F.when(cond, F.lit(weight)) if expr is None else expr.when(cond, F.lit(weight))
    return expr.otherwise(F.lit(None).cast("int"))


def event_weight(reason: Column, ms_played: Column) -> Column:
    """Reason weight x ms played, exact DECIMAL(18,4).

    A play value too large for the type gives NULL (the row is dropped like an
    unknown reason) instead of failing the job.
    """
    return reason_weight(reason).cast(REASON_WEIGHT_TYPE) * ms_played.try_cast(PLAYED_TYPE)


def double_event_weight(reason: Column, ms_played: Column) -> Column:
    """P6 for play times of any size: one IEEE multiply, as the reference does.

    Sums of such weights are taken exactly (``functions.exact``). A product
    beyond the largest double gives NULL.
    """
    weight = reason_weight(reason).cast("double") * ms_played.cast("double")
    return F.when(F.abs(weight) < float("inf"), weight)


def rec_score(similarity: Column, weight: Column) -> Column:
    """Similarity (6 decimals) x event weight as DOUBLE."""
    return similarity.cast(SIMILARITY_TYPE).cast("double") * weight.cast("double")


def diversity_ratio(user_id: Column, score: Column, literal: bool = False) -> Column:
    """User id / rec score.

    Default: NULL for a zero score (ANSI mode would raise). ``literal=True``
    reproduces JVM double division: +-Infinity, and NaN for 0 / 0.
    """
    num = user_id.cast("double")
    den = score.cast("double")
    if not literal:
        return F.when(den == 0, F.lit(None).cast("double")).otherwise(num / den)
    inf = F.lit(float("inf"))
    return (F.when((den == 0) & (num == 0), F.lit(float("nan")))
            .when((den == 0) & (num > 0), inf)
            .when(den == 0, -inf)
            .otherwise(num / den))

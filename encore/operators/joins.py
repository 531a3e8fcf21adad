"""Join helpers: broadcast a side only behind a proven bound on its rows.

When the bound is above the limit the join stays a shuffle join; adaptive
query execution then splits skewed partitions (``spark.sql.adaptive.skewJoin``)
and may still switch to a broadcast if the measured shuffle output is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# About 100 bytes a row: 2,000,000 rows stay well under the driver's and the
# executors' broadcast budget.
DEFAULT_BROADCAST_ROWS = 2_000_000


def broadcast_if_bounded(df: DataFrame, row_bound: int | None,
                         limit: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``F.broadcast(df)`` if ``row_bound`` (a proven upper bound) is within ``limit``."""
    if row_bound is not None and row_bound <= limit:
        return F.broadcast(df)
    return df


def reshuffled(key: str) -> Column:
    """The same BIGINT key as an expression whose partitioning the planner does not know.

    An aggregate joined on its own key needs no exchange, and adaptive
    execution splits a skewed join only where both sides come from one. With
    this key the (small) aggregate is exchanged once more, and a hot key splits.
    """
    return F.bitwise_not(F.bitwise_not(F.col(key).cast("bigint")))

"""User buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the reference's sizing: 60,000,000 users in 10 ranges of
# 6,000,000, and the older hash placement 1 + user id % 4.
RANGE_WIDTH = 6_000_000
HASH_BUCKETS = 4


def range_bucket(user_id: Column, width: int = RANGE_WIDTH) -> Column:
    """Which user range an id falls in (BIGINT arithmetic, no overflow)."""
    return F.floor(user_id.cast("bigint") / F.lit(width)).cast("bigint")


def hash_bucket(user_id: Column, buckets: int = HASH_BUCKETS) -> Column:
    """1-based hash bucket."""
    return (F.lit(1) + F.pmod(user_id.cast("bigint"), F.lit(buckets))).cast("int")

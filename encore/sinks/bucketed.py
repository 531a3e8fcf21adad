"""Accumulated ratings in a bucketed table (J1, A4, K4): an upsert moves the day's rows alone.

The table is hashed on (user, track) into a fixed number of buckets, one file
each. Spark's bucketed scan tells the planner so: the join with the day's sums,
dealt to as many partitions by the same hash, has no exchange over the
accumulated side, and its output already lies in the buckets it is written
to. A version is a new folder and never overwritten; the catalog only names it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from encore.functions import exact
from encore.operators.merge import PAIR, day_sums, merge_day, rating_grid


def _named(path: str) -> str:
    """A table name for a version's folder."""
    return "encore_" + re.sub(r"\W+", "_", path.rstrip("/").rsplit("/", 1)[-1])


def _write(ratings: DataFrame, path: str, buckets: int) -> str:
    (ratings.write.mode("errorifexists").format("parquet").option("path", path)
     .bucketBy(buckets, *PAIR).sortBy(*PAIR).saveAsTable(_named(path)))
    return path


def write_ratings(ratings: DataFrame, path: str, buckets: int) -> str:
    """The first version: (user_id, track_id, ts, rating), one row a pair, shuffled once into ``buckets``."""
    return _write(ratings.select(*PAIR, "ts", "rating").repartition(buckets, *PAIR), path, buckets)


def buckets_of(spark: SparkSession, path: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_named(path)}").filter("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"])


def attach(spark: SparkSession, path: str, buckets: int) -> str:
    """Name a version that another application wrote."""
    keys = ", ".join(PAIR)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_named(path)} (user_id BIGINT, track_id BIGINT, ts TIMESTAMP_NTZ, rating DOUBLE) "
              f"USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.table(_named(path))


def upserted(spark: SparkSession, path: str, daily_scores: DataFrame, score: str = "score",
             grid: exact.Grid | None = None) -> DataFrame:
    """``merge_ratings`` of the table at ``path`` and the day's scores.

    The day is summed by pair first (so a hot pair is one row), then dealt to
    the table's buckets.
    """
    acc = read(spark, path)
    grid = grid or rating_grid(acc, daily_scores, score)
    day = day_sums(daily_scores, grid, score).repartition(buckets_of(spark, path), *PAIR)
    return merge_day(acc, day, grid)


def upsert(spark: SparkSession, path: str, daily_scores: DataFrame, new_path: str, score: str = "score") -> str:
    """Write the next version; returns its path."""
    return _write(upserted(spark, path, daily_scores, score), new_path, buckets_of(spark, path))

"""Table and line sinks (K1-K4, K6).

Every write goes to a directory that did not exist before (the job's output
committer publishes it whole), and inputs are never overwritten in place:
the caller switches to the returned path once the write has succeeded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators.aggregates import recs_by_user
from encore.session import scratch_path, shuffles_removed
from encore.sources.text import to_rating_lines, write_lines


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage of an expensive intermediate that is used more than once
    (a lost executor then re-reads the table instead of recomputing it). Its
    shuffle files go with the write.
    """
    with shuffles_removed(df.sparkSession):
        path = write_table(df, scratch_path(spark, name))
    return spark.read.parquet(path)


def write_user_recs(recs: DataFrame, path: str, n: int) -> str:
    """K1: one row per user with the recs array (contents, not an object id).

    The score before the diversity step is kept where there is one: that is
    what the next day merges with its own scores.
    """
    also = ("base_score",) if "base_score" in recs.columns else ()
    return write_table(recs_by_user(recs, n, also), path)


def read_user_recs(spark: SparkSession, path: str) -> DataFrame:
    """K1 read back, one row per rec."""
    return (spark.read.parquet(path)
            .select("user_id", F.explode("recs").alias("r"))
            .select("user_id", "r.rank", "r.track_id", "r.score"))


def read_previous_recs(spark: SparkSession, path: str) -> DataFrame:
    """(user_id, track_id, score) of a flat table or of an earlier K1 output.

    From K1 it takes the score before the diversity step, on the scale of
    today's raw scores.
    """
    table = spark.read.parquet(path)
    if "recs" in table.columns:
        table = table.select("user_id", F.explode("recs").alias("r")).select("user_id", "r.*")
    score = "base_score" if "base_score" in table.columns else "score"
    return table.select("user_id", "track_id", F.col(score).alias("score"))


def write_rating_lines(ratings: DataFrame, path: str) -> str:
    """K4: ``user,track,epoch_seconds,rating`` lines in a new directory."""
    return write_lines(to_rating_lines(ratings), path)

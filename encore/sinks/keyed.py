"""Tables laid out by user bucket (S7, F5, T6): a micro-batch reads its users' buckets alone.

``bucket`` is a partition column, so the buckets of a batch's users prune
whole folders before any file is listed or opened. Their numbers are collected
first: at most as many as the layout has buckets, whatever the batch holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions.bucket import hash_bucket

BUCKET = "_user_bucket"


@dataclass(frozen=True)
class UserTable:
    """A table written by ``write_by_user``."""

    spark: SparkSession
    path: str
    schema: str
    buckets: int

    def all(self) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, {BUCKET} int").parquet(self.path)

    def of(self, users: DataFrame) -> DataFrame:
        """The rows of ``users`` (user_id)."""
        wanted = users.filter("user_id is not null").select(hash_bucket(F.col("user_id"), self.buckets).alias("b")).distinct().collect()
        mine = self.all().filter(F.col(BUCKET).isin([r.b for r in wanted]))
        return mine.drop(BUCKET).join(users, "user_id", "left_semi")


def write_by_user(df: DataFrame, path: str, buckets: int) -> UserTable:
    """Write ``df`` (with a user_id) by bucket; rows without a user belong to no batch and are not written.

    Rebalanced by bucket: a bucket with a very active user is split over
    several tasks and files, small ones share a task.
    """
    placed = df.filter("user_id is not null").withColumn(BUCKET, hash_bucket(F.col("user_id"), buckets))
    placed.hint("rebalance", F.col(BUCKET)).write.mode("errorifexists").partitionBy(BUCKET).parquet(path)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return UserTable(df.sparkSession, path, fields, buckets)

"""Merges of ratings and recommendation lists.

The reference upserts into an in-memory map; here a merge is a union and one
``groupBy``: one shuffle on (user, track) with partial aggregation. Sums of
ratings are exact (``functions.exact``) and rounded once. With the accumulated
ratings stored in buckets (``sinks.bucketed``) a merge moves the day's rows alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions import exact

RATING_SUM_TYPE = "decimal(38,6)"
SCORE_TYPE = "double"


PAIR = ["user_id", "track_id"]


def _grid(df: DataFrame, column: str) -> exact.Grid:
    """The exact sum's grid for a column: from its type if that is a decimal, else from its values."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return exact.decimal_grid(kind.precision, kind.scale)
    return exact.grid_of(df, column)


def rating_grid(acc: DataFrame, daily_scores: DataFrame, score: str = "score") -> exact.Grid:
    """A grid that holds the accumulated ratings and the day's scores."""
    one, two = _grid(acc, "rating"), _grid(daily_scores, score)
    return exact.Grid(min(one.low, two.low), max(one.high, two.high))


def merge_ratings(acc: DataFrame, daily_scores: DataFrame, score: str = "score",
                  grid: exact.Grid | None = None) -> DataFrame:
    """Upsert daily scores into accumulated ratings.

    Present (user, track): rating + sum of the day's scores; absent: inserted.
    Time is the latest time seen (the reference keeps the last one read).
    The sum of a pair's doubles is exact and rounded once, so neither order nor
    partitioning changes a bit of it. Without ``grid`` (see ``rating_grid``) one
    pass over the ratings finds it.
    """
    grid = grid or rating_grid(acc, daily_scores, score)
    left = acc.select(*PAIR, "ts", F.col("rating").cast("double").alias("_r"))
    right = daily_scores.select(*PAIR, "ts", F.col(score).cast("double").alias("_r"))
    sums = exact.split(left.unionByName(right), "_r").groupBy(*PAIR).agg(
        F.max("ts").alias("ts"), exact.place_sums(grid).alias("_sum"))
    return exact.with_rounded(sums, "_sum", grid, "rating")


def day_sums(daily_scores: DataFrame, grid: exact.Grid, score: str = "score") -> DataFrame:
    """One row a pair: the day's latest time and its exact sum in parts (``exact.place_sums``)."""
    scores = daily_scores.select(*PAIR, "ts", F.col(score).cast("double").alias("_r"))
    return exact.split(scores, "_r").groupBy(*PAIR).agg(F.max("ts").alias("_day_ts"),
                                                        exact.place_sums(grid).alias("_day"))


def merge_day(acc: DataFrame, day: DataFrame, grid: exact.Grid) -> DataFrame:
    """J1 as a join: ``acc`` with one row a pair, ``day`` from ``day_sums``.

    Sides that lie in the same hash partitions of the pair are not moved.
    """
    there = acc.select(*[F.col(c).alias(f"_{c}") for c in PAIR], "ts", "rating")
    own = exact.split(there, "rating").withColumn("_own", exact.place_values(grid))
    same = [own[f"_{c}"] == day[c] for c in PAIR]
    met = own.join(day, same, "full_outer").select(
        *[F.coalesce(f"_{c}", c).alias(c) for c in PAIR],
        F.greatest("ts", "_day_ts").alias("ts"), exact.added(F.col("_own"), F.col("_day")).alias("_sum"))
    return exact.with_rounded(met, "_sum", grid, "rating")


def latest_rating(ratings: DataFrame) -> DataFrame:
    """One row per (user, track); the latest put wins, ties by the larger rating."""
    return (ratings.groupBy("user_id", "track_id")
            .agg(F.max("ts").alias("ts"),
                 F.max_by("rating", F.struct("ts", "rating")).alias("rating")))


def user_ratings_and_events(ratings: DataFrame, events: DataFrame,
                            weight: str = "weight") -> DataFrame:
    """Each rating user with the size and sum of their ratings and daily events.

    Both sides are reduced to one row per user before the join, so a user
    with a third of all events costs one row in the join, not a list.
    """
    r = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_ratings"),
                                       F.sum(F.col("rating").cast(RATING_SUM_TYPE))
                                       .alias("rating_sum"))
    e = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"),
                                      F.sum(F.col(weight).cast(RATING_SUM_TYPE))
                                      .alias("weight_sum"))
    return (r.join(e, "user_id", "left")
            .select("user_id", "n_ratings", F.col("rating_sum").cast("double").alias("rating_sum"),
                    F.coalesce("n_events", F.lit(0)).alias("n_events"),
                    F.col("weight_sum").cast("double").alias("weight_sum")))


def merge_prev_recs(today: DataFrame, previous: DataFrame,
                    today_users_only: bool = True) -> DataFrame:
    """Union today's recs with earlier ones; one row per (user, track), best score.

    As in the reference, the earlier list is fetched for the users of today's
    list only (a semi join that also keeps the earlier table out of the
    shuffle for everyone else); ``today_users_only=False`` merges all users.
    """
    cols = lambda df: df.select("user_id", "track_id",
                                F.col("score").cast(SCORE_TYPE).alias("score"))
    if today_users_only:
        previous = previous.join(today.select("user_id").distinct(), "user_id", "left_semi")
    return (cols(today).unionByName(cols(previous))
            .groupBy("user_id", "track_id")
            .agg(F.max("score").alias("score")))

"""Model trainer: F1 -> F2 -> F3 -> J1 -> F2 -> P5 -> M1 -> M2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions.parse import to_als_rating
from encore.operators.filters import (ACTIVE_MONTHS, MIN_TRACK_LISTENS, filter_active_tracks,
                                      filter_active_users, filter_recent)
from encore.operators.merge import merge_ratings
from encore.operators.model import item_factors, train_implicit_als
from encore.sinks.files import materialize
from encore.sources import testdata

MIN_USER_RATINGS = 10


def merged_active_ratings(acc: DataFrame, daily_scores: DataFrame, as_of: str,
                          min_listens: int = MIN_TRACK_LISTENS, months: int = ACTIVE_MONTHS,
                          min_user_ratings: int = MIN_USER_RATINGS,
                          mode: str = "any") -> DataFrame:
    """F1 -> F2 -> F3 -> J1 -> F2: the new accumulated ratings (user, track, ts, rating).

    ``daily_scores``: (user_id, track_id, ts, score). Every activity filter
    reads its input twice, so the merged ratings are written before the last
    one; ``acc`` should be a stored table too.
    """
    recent = filter_recent(acc, as_of)
    tracks = filter_active_tracks(recent, as_of, min_listens, months, mode)
    users = filter_active_users(tracks, min_user_ratings)
    merged = materialize(acc.sparkSession, merge_ratings(users, daily_scores), "merged_all")
    return filter_active_tracks(merged, as_of, min_listens, months, mode)


def training_ratings(acc: DataFrame, daily_scores: DataFrame, as_of: str,
                     min_listens: int = MIN_TRACK_LISTENS, months: int = ACTIVE_MONTHS,
                     min_user_ratings: int = MIN_USER_RATINGS, mode: str = "any") -> DataFrame:
    """``merged_active_ratings`` cast for ALS (P5): (user_id INT, track_id INT, rating)."""
    return to_als_rating(merged_active_ratings(acc, daily_scores, as_of, min_listens, months,
                                               min_user_ratings, mode))


def history_training_ratings(spark: SparkSession, sf_dir: str, mode: str = "any") -> DataFrame:
    """``training_ratings`` on the test history.

    The history is a lineitem x orders join; the retained part is written
    once (the activity filters read it several times), as a stored
    accumulated-ratings table would be.
    """
    daily = testdata.history_daily(spark, sf_dir).withColumnRenamed("rating", "score")
    acc = materialize(spark, filter_recent(testdata.history_acc(spark, sf_dir),
                                           testdata.HISTORY_AS_OF), "recent_ratings")
    return training_ratings(acc, daily, testdata.HISTORY_AS_OF, mode=mode)


def train_item_factors(spark: SparkSession, sf_dir: str, rank: int = 40, iterations: int = 15,
                       blocks: int | None = None) -> DataFrame:
    """M1 + M2 (+ K3): trained item factors written to the shared folder."""
    ratings = materialize(spark, history_training_ratings(spark, sf_dir), "training_ratings")
    model = train_implicit_als(ratings, rank=rank, iterations=iterations, blocks=blocks)
    return materialize(spark, item_factors(model), "item_factors")


def item_factor_summary(factors: DataFrame) -> DataFrame:
    """Property view of factors: one row per track with its rank and finiteness."""
    return factors.select(
        "track_id", F.size("features").alias("n_dims"),
        F.forall("features", lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        .alias("finite"))

"""Event weighting, candidate generation and diversity.

Events are first reduced to one row per (user, track) holding the largest and
smallest weight: a candidate's score from a track is similarity x weight, so
its best value over that track's events is sim x max weight (sim >= 0) or
sim x min weight (sim < 0). The fan-out join then sees distinct pairs, not
raw events, and a user who replays one track a million times costs one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.score import double_event_weight, event_weight, reason_weight, rec_score
from encore.operators.joins import broadcast_if_bounded


def _weight(doubles: bool):
    return (double_event_weight if doubles else event_weight)(F.col("reason_start"), F.col("ms_played"))


def weigh_events(events: DataFrame, mode: str = "drop", doubles: bool = False) -> DataFrame:
    """Add ``weight``; unknown reasons get NULL and are dropped (``mode='drop'``),
    kept (``'keep'``) or fail the job (``'failfast'``). Weights are exact decimals, or
    with ``doubles`` (for ``merge_ratings``, whose sums of doubles are exact) doubles of any size."""
    out = events.withColumn("weight", _weight(doubles))
    if mode == "keep":
        return out
    if mode == "failfast":
        out = out.withColumn("_check", F.when(
            F.col("weight").isNull(),
            F.raise_error(F.concat(F.lit("unknown reason: "), F.col("reason_start")))))
        return out.filter(F.col("_check").isNull()).drop("_check")
    if mode != "drop":
        raise ValueError(f"mode must be 'drop', 'keep' or 'failfast', not {mode!r}")
    return out.filter(F.col("weight").isNotNull())


def refused_events(parsed: DataFrame, doubles: bool = False) -> DataFrame:
    """(line, parse_error) of the lines that get no weight, from ``parse_daily_lines``."""
    why = (F.when(F.col("parse_error").isNotNull(), F.col("parse_error"))
           .when(reason_weight(F.col("reason_start")).isNull(), F.lit("unknown reason"))
           .when(_weight(doubles).isNull(),
                 F.lit("ms_played too large for a weight")))
    return parsed.select("line", why.alias("parse_error")).filter(F.col("parse_error").isNotNull())


def user_track_weights(weighted: DataFrame) -> DataFrame:
    """(user, track) -> largest and smallest event weight (partial aggregation)."""
    w = F.col("weight").cast("double")
    return weighted.groupBy("user_id", "track_id").agg(F.max(w).alias("max_w"),
                                                       F.min(w).alias("min_w"))


def event_candidates(weighted: DataFrame, similar: DataFrame,
                     similar_rows_bound: int | None) -> DataFrame:
    """J4 applied to events + P9: (user_id, track_id, score) with the best
    score each candidate track reaches for the user."""
    pairs = user_track_weights(weighted)
    sim = broadcast_if_bounded(
        similar.select("track_id", "similar_track_id", "similarity"), similar_rows_bound)
    best_w = F.when(F.col("similarity") >= 0, F.col("max_w")).otherwise(F.col("min_w"))
    scored = pairs.join(sim, "track_id").select(
        "user_id", F.col("similar_track_id").alias("track_id"),
        rec_score(F.col("similarity"), best_w).alias("score"))
    return scored.groupBy("user_id", "track_id").agg(F.max("score").alias("score"))


def attach_labels(recs: DataFrame, labels: DataFrame, labels_rows_bound: int | None) -> DataFrame:
    """Track -> label lookup (left join; tracks without a vector keep NULL)."""
    lab = broadcast_if_bounded(labels.select("track_id", "label"), labels_rows_bound)
    return recs.join(lab, "track_id", "left")


def diversity_reweight(recs: DataFrame, labels: DataFrame,
                       labels_rows_bound: int | None) -> DataFrame:
    """Divide each rec's score by its rank among the user's recs of the same label.

    The reference names this step without defining it; the definition is ours.
    ``recs`` is already cut to a bounded number per user, so the window groups
    are small. ``base_score`` keeps the input score.
    """
    with_label = attach_labels(recs, labels, labels_rows_bound)
    w = Window.partitionBy("user_id", "label").orderBy(F.col("score").desc(),
                                                       F.col("track_id").asc())
    return (with_label.withColumn("label_rank", F.row_number().over(w))
            .select("user_id", "track_id", "label", "label_rank",
                    F.col("score").alias("base_score"),
                    (F.col("score") / F.col("label_rank")).alias("score")))

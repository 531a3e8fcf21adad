"""Aggregations.

Aggregates keep numbers, not lists, wherever the consumer allows: partial
aggregation then shrinks hot keys on the map side. The only lists built are
bounded by construction (top-N per user).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def track_activity(ratings: DataFrame) -> DataFrame:
    """Listens and last activity per track."""
    return ratings.groupBy("track_id").agg(F.count(F.lit(1)).alias("listens"),
                                           F.max("ts").alias("last_active"))


def user_activity(ratings: DataFrame) -> DataFrame:
    """Ratings and last activity per user."""
    return ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("listens"),
                                          F.max("ts").alias("last_active"))


def events_by_track(events: DataFrame, weight: str = "weight") -> DataFrame:
    """Per track the number of events, listeners' events summed by weight.

    The reference concatenates per-track event lists ("could be a long list
    for hot songs"); counts and sums carry what the later steps use and stay
    small under any skew.
    """
    return events.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(weight).alias("weight_sum"),
        F.max("ts").alias("last_ts"))


def recs_by_user(recs: DataFrame, n: int, also: tuple[str, ...] = ()) -> DataFrame:
    """A2: each user's recs of rank 1 to ``n`` as one sorted array.

    The cut is made before the lists are built, so a list holds ``n`` recs at
    most whatever comes in. ``also`` names further columns of a rec.
    """
    return (recs.filter(F.col("rank") <= n).groupBy("user_id")
            .agg(F.sort_array(F.collect_list(F.struct("rank", "track_id", "score", *also)))
                 .alias("recs")))


def _partial_gram(dim: int):
    def run(batches):
        acc = np.zeros((dim, dim), dtype=np.float64)
        seen = False
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf["features"].to_numpy()).astype(np.float64)
            acc += x.T @ x
            seen = True
        if seen:
            i, j = np.meshgrid(np.arange(dim), np.arange(dim), indexing="ij")
            yield pd.DataFrame({"i": i.ravel().astype(np.int32),
                                "j": j.ravel().astype(np.int32),
                                "value": acc.ravel()})
    return run


def gram_matrix(vectors: DataFrame, dim: int, features: str = "features") -> DataFrame:
    """A10: X^T X of the factor rows, as (i, j, value).

    Each partition folds its rows into one dim x dim partial sum (numpy); the
    shuffle carries dim^2 rows per partition, never a row per vector pair.
    """
    partial = (vectors.select(F.col(features).cast("array<double>").alias("features"))
               .mapInPandas(_partial_gram(dim), "i int, j int, value double"))
    return partial.groupBy("i", "j").agg(F.sum("value").alias("value"))


def gram_array(vectors: DataFrame, dim: int, features: str = "features") -> np.ndarray:
    """X^T X as a dim x dim array on the driver."""
    return as_array(gram_matrix(vectors, dim, features), dim)


def as_array(gram: DataFrame, dim: int) -> np.ndarray:
    """(i, j, value) as a dim x dim array."""
    out = np.zeros((dim, dim))
    for row in gram.collect():  # dim x dim values
        out[row["i"], row["j"]] = row["value"]
    return out

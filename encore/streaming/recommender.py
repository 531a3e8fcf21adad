"""Streaming recommender (T6): the batch operators applied per micro-batch.

S5 -> P1 -> P8 -> J4 -> P14 -> P9 -> F5 -> A2 -> J5 -> P12 -> W3 -> K2.
The similar-tracks index, yesterday's recs and the dismissals are tables read
by each batch (so updates to them apply at the next batch). Before the
shuffles, both are cut to the batch's users with a semi join: the batch's
user set is small and broadcast by adaptive execution, so a micro-batch never
shuffles the whole dismissal or recommendation table.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.parse import parse_daily
from encore.operators.cells import CellIndex
from encore.operators.model import fold_in_items
from encore.operators.recommend import weigh_events
from encore.operators.similar import nearest_of
from encore.plans.batch import DEFAULT_K, SimilarIndex, candidate_recs, recommend
from encore.sinks.files import materialize
from encore.sinks.keyed import UserTable
from encore.streaming.carried import latest_vectors


@dataclass
class Refresh:
    """M4 in the stream: what re-solves the vectors of a batch's tracks.

    ``vectors`` (track_id, features, label) are the item factors the index was
    built from and ``users`` the user factors of the same model, with ``gram``
    = Y^T Y; ``k`` is the length of the index's lists. ``cells`` is a stored
    index of the same vectors that is probed instead of searching them all.
    ``carried`` is the output of ``carried.folded_stream``: a track's newest
    vector there goes before one folded from this batch alone.
    """
    vectors: DataFrame
    users: DataFrame
    gram: np.ndarray
    rank: int
    k: int = DEFAULT_K
    cells: CellIndex | None = None
    carried: str | None = None


def refreshed_index(index: SimilarIndex, events: DataFrame, refresh: Refresh) -> SimilarIndex:
    """The index with the lists of the batch's tracks searched anew by their refreshed vectors.

    Only tracks played by a user with a vector are refreshed; the others keep
    their stored lists. The batch's tracks are asked against all vectors in
    blocks, or the stored cells; their neighbours' vectors stay as stored.
    """
    ratings = (weigh_events(events).select("user_id", "track_id", F.col("weight").alias("rating"))
               .join(refresh.users.select("user_id"), "user_id", "left_semi"))
    tracks = ratings.select("track_id").distinct()
    n_tracks = tracks.count()
    fresh = fold_in_items(ratings, refresh.users, refresh.gram, refresh.rank)
    if refresh.carried:
        known = latest_vectors(tracks.sparkSession, refresh.carried).join(tracks, "track_id", "left_semi")
        known = materialize(tracks.sparkSession, known, "carried_vectors")
        fresh = known.unionByName(fresh.join(known.select("track_id"), "track_id", "left_anti"))
    if refresh.cells:
        lists = refresh.cells.nearest(fresh, refresh.k)
    else:
        lists = nearest_of(fresh, refresh.vectors, refresh.k, n_tracks, index.n_vectors)
    columns = ["track_id", "similar_track_id", "similarity"]
    table = (index.table.join(tracks, "track_id", "left_anti").select(*columns)
             .unionByName(lists.select(*columns)))
    return replace(index, table=table, rows_bound=index.rows_bound + refresh.k * n_tracks)


def rows_of_users(table: DataFrame | UserTable, users: DataFrame) -> DataFrame:
    """The rows of a batch's users: a semi join, over their buckets alone if the table is laid out by user."""
    return table.of(users) if isinstance(table, UserTable) else table.join(users, "user_id", "left_semi")


def recommend_transform(index: SimilarIndex, dismissals: DataFrame | UserTable,
                        previous: DataFrame | UserTable | None, n: int = 30,
                        refresh: Refresh | None = None):
    """foreachBatch transform: daily lines -> final recs of the batch's users.

    With ``refresh``, candidates come from the batch's refreshed track vectors.
    """
    def transform(batch_lines: DataFrame, batch_id: int) -> DataFrame:
        events = parse_daily(batch_lines)
        users = events.select("user_id").distinct()
        prev = None if previous is None else rows_of_users(previous, users)
        known = index if refresh is None else refreshed_index(index, events, refresh)
        out = recommend(events, known, rows_of_users(dismissals, users), prev, n)
        return out.select("user_id", "rank", "track_id", "score", "base_score",
                          F.lit(batch_id).alias("batch_id"))
    return transform


def top_n_transform(index: SimilarIndex, dismissals: DataFrame | UserTable, n: int = 30):
    """W3 per batch: today's candidates cut to ``n`` per user."""
    def transform(batch_lines: DataFrame, batch_id: int) -> DataFrame:
        events = parse_daily(batch_lines)
        users = events.select("user_id").distinct()
        out = candidate_recs(events, index, rows_of_users(dismissals, users), n)
        return out.select("user_id", "rank", "track_id", F.col("score").cast("double"),
                          F.lit(batch_id).alias("batch_id"))
    return transform


def fold_in_transform(users: DataFrame, gram, rank: int):
    """M4 per batch: refresh the vectors of the batch's tracks from its events.

    The batch's plays are weighed (P8) and summed per (user, track) into an
    implicit rating; item vectors are re-solved against the fixed user
    factors ``users`` with the broadcast ``gram`` = Y^T Y (rank x rank).
    """
    def transform(batch_lines: DataFrame, batch_id: int) -> DataFrame:
        events = weigh_events(parse_daily(batch_lines))
        ratings = events.select("user_id", "track_id", F.col("weight").alias("rating"))
        vectors = fold_in_items(ratings, users, gram, rank)
        return vectors.withColumn("batch_id", F.lit(batch_id))
    return transform

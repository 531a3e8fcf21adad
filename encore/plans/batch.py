"""Batch recommender: P6 -> J4 -> F5 -> P9 -> W1 -> J5 -> F5 -> P12 -> W2.

Shuffles: events are reduced per (user, track); the similar-tracks table and
the label table are broadcast when their proven row bound allows (k rows and
one row per vector); candidates are reduced per (user, track); the anti joins
shuffle on (user, track); the top-N windows shuffle on user after a per-map
WindowGroupLimit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators.filters import filter_dismissed
from encore.operators.merge import merge_prev_recs
from encore.operators.recommend import diversity_reweight, event_candidates, weigh_events
from encore.operators.similar import one_vector_per_track, similar_tracks, similar_tracks_lsh
from encore.operators.topn import top_n_per_key, user_top_n
from encore.sinks.files import materialize
from encore.sources import testdata

DEFAULT_N = 30
DEFAULT_K = 10


@dataclass
class SimilarIndex:
    """Similar-tracks table with the row bounds used to size broadcasts."""
    table: DataFrame
    labels: DataFrame
    n_vectors: int
    rows_bound: int


def _labels(vectors: DataFrame) -> DataFrame:
    """Each track's label, written once: lists and micro-batches read two columns, no vectors."""
    return materialize(vectors.sparkSession,
                       one_vector_per_track(vectors).select("track_id", "label"), "labels")


def build_index(vectors: DataFrame, k: int = DEFAULT_K, n_vectors: int | None = None,
                mode: str = "exact") -> SimilarIndex:
    """J4 once per run, written to the shared checkpoint folder (used by both
    the previous and today's lists, and by every micro-batch of a stream).

    ``mode`` is the caller's choice at every size: "exact" (J4) or "lsh" (J8, approximate).
    """
    if mode not in ("exact", "lsh"):
        raise ValueError(f"mode must be 'exact' or 'lsh', not {mode!r}")
    if n_vectors is None:
        n_vectors = vectors.count()
    sim = (similar_tracks(vectors, k, n_vectors) if mode == "exact"
           else similar_tracks_lsh(vectors, k))
    table = materialize(vectors.sparkSession, sim, "similar_tracks")
    return SimilarIndex(table, _labels(vectors), n_vectors, k * n_vectors)


def load_index(spark: SparkSession, index_path: str, vectors: DataFrame) -> SimilarIndex:
    """A similar-tracks table written earlier (K6), with the row counts of the tables read."""
    table, labels = spark.read.parquet(index_path), _labels(vectors)
    return SimilarIndex(table, labels, labels.count(), table.count())  # both from footers


def candidate_recs(events: DataFrame, index: SimilarIndex, dismissals: DataFrame,
                   n: int = DEFAULT_N, ascending: bool = False) -> DataFrame:
    """P6 -> J4 -> F5 -> P9 -> W1: (user_id, rank, track_id, score)."""
    weighted = weigh_events(events)
    cands = event_candidates(weighted, index.table, index.rows_bound)
    kept = filter_dismissed(cands, dismissals)
    return user_top_n(kept, n, ascending)


def finalize_recs(today: DataFrame, previous: DataFrame | None, index: SimilarIndex,
                  dismissals: DataFrame, n: int = DEFAULT_N) -> DataFrame:
    """J5 -> F5 -> P12 -> W2: (user_id, rank, track_id, score, base_score, label)."""
    merged = today.select("user_id", "track_id", "score")
    if previous is not None:
        merged = merge_prev_recs(merged, previous)
    kept = filter_dismissed(merged, dismissals)
    diverse = diversity_reweight(kept, index.labels, index.n_vectors)
    ranked = top_n_per_key(diverse, n, "user_id", "score", "track_id")
    return ranked.select("user_id", "rank", "track_id", "score", "base_score", "label")


def recommend(events: DataFrame, index: SimilarIndex, dismissals: DataFrame,
              previous: DataFrame | None, n: int = DEFAULT_N) -> DataFrame:
    today = candidate_recs(events, index, dismissals, n)
    return finalize_recs(today, previous, index, dismissals, n)


def previous_recs(spark: SparkSession, sf_dir: str, index: SimilarIndex,
                  n: int = DEFAULT_N) -> DataFrame:
    """Yesterday's list: P6..W1 on plays before the daily cutoff, filtered by the
    dismissals known before it."""
    before = testdata.plays_before(spark, sf_dir)
    old_dismissals = testdata.dismissals(spark, sf_dir, before=testdata.DAILY_CUTOFF)
    return candidate_recs(before, index, old_dismissals, n).select("user_id", "track_id", "score")


def batch_recommendations(spark: SparkSession, sf_dir: str, n: int = DEFAULT_N,
                          k: int = DEFAULT_K) -> DataFrame:
    """Flagship: today's recommendations per user from the daily plays."""
    index = build_index(testdata.vectors(spark, sf_dir), k)
    dismissals = testdata.dismissals(spark, sf_dir)
    prev = previous_recs(spark, sf_dir, index, n)
    out = recommend(testdata.daily(spark, sf_dir), index, dismissals, prev, n)
    return out.select("user_id", "rank", "track_id", "score", "base_score")

"""Model operators (M1-M4): implicit ALS, item factors, fold-in of new events."""

from __future__ import annotations

import threading
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators.joins import reshuffled

# Fixed values of the reference's training configuration.
ALS_RANK = 40
ALS_ITERATIONS = 15
ALS_LAMBDA = 0.01
ALS_ALPHA = 40.0

#: Rating rows that one ALS block takes in, about.
BLOCK_RATINGS = 1_000_000
#: Bytes of factors in shuffle files that the iterations since the last checkpoint may have left, about.
KEPT_BYTES = 1 << 30
#: Seconds between two looks for shuffles that no later iteration can ask for.
_LOOK_S = 5.0
#: (user, track) pairs of one track that one task folds; a track with more is dealt over several.
FOLD_PAIRS = 100_000
#: Tracks whose equations are handed on together.
_FOLD_ROWS = 256


def iterations_kept(n_ratings: int, rank: int, most: int) -> int:
    """Iterations between two checkpoints: ``most``, fewer where their shuffles hold over ``KEPT_BYTES``.

    An iteration sends the user factors to the item blocks and the item factors
    to the user blocks, each at most once for each rating.
    """
    return most if most < 1 else max(1, min(most, KEPT_BYTES // max(1, 2 * 4 * rank * n_ratings)))


@contextmanager
def unreachable_removed(spark: SparkSession, every: float = _LOOK_S):
    """Shuffles that nothing refers to any more go every few seconds, not when the driver's heap fills.

    Spark's cleaner removes a shuffle's files once the driver's garbage
    collector finds it unreachable. The fit is one call with thousands of
    small objects on the driver, whose own collections come too late.
    """
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # no driver-side context (Spark Connect)
        jvm = None
    done = threading.Event()

    def look():
        while not done.wait(every):
            jvm.System.gc()

    thread = threading.Thread(target=look, daemon=True)
    if jvm is not None:
        thread.start()
    try:
        yield
    finally:
        done.set()
        if jvm is not None:
            thread.join()


def train_implicit_als(ratings: DataFrame, rank: int = ALS_RANK,
                       iterations: int = ALS_ITERATIONS, reg: float = ALS_LAMBDA,
                       alpha: float = ALS_ALPHA, blocks: int | None = None,
                       seed: int = 42, checkpoint_interval: int = 10) -> ALSModel:
    """M1: implicit-feedback ALS on (user_id INT, track_id INT, rating).

    ``blocks`` defaults to a user and an item block per ``BLOCK_RATINGS``
    ratings, at least one per core that the session has when the fit starts
    (pass a written table: its rows are counted). Lineage is cut every ``checkpoint_interval`` iterations
    into the session's checkpoint folder, so a lost executor costs at most
    that many iterations; sooner where the shuffle files of so many iterations
    would fill the disks (``iterations_kept``), and those before it are removed.
    """
    spark = ratings.sparkSession
    n_ratings = ratings.count()
    if blocks is None:
        try:
            cores = max(1, spark.sparkContext.defaultParallelism)
        except Exception:  # no driver-side context (Spark Connect)
            cores = int(spark.conf.get("spark.sql.shuffle.partitions", "10"))
        blocks = max(cores, -(-n_ratings // BLOCK_RATINGS))
    als = ALS(rank=rank, maxIter=iterations, regParam=reg, alpha=alpha, implicitPrefs=True,
              userCol="user_id", itemCol="track_id", ratingCol="rating",
              numUserBlocks=blocks, numItemBlocks=blocks, seed=seed,
              checkpointInterval=iterations_kept(n_ratings, rank, checkpoint_interval), coldStartStrategy="drop")
    with unreachable_removed(spark):
        return als.fit(ratings.select("user_id", "track_id",
                                      F.col("rating").cast("float").alias("rating")))


def item_factors(model: ALSModel) -> DataFrame:
    """M2: (track_id INT, features ARRAY<FLOAT>)."""
    return model.itemFactors.select(F.col("id").alias("track_id"), "features")


def user_factors(model: ALSModel) -> DataFrame:
    return model.userFactors.select(F.col("id").alias("user_id"), "features")


def _summed_runs(rows):
    """(track, array) rows that come in runs of one track -> each track with the sum of its arrays."""
    track, total = None, None
    for t, part in rows:
        if t == track:
            total = total + part
            continue
        if track is not None:
            yield track, total
        track, total = t, part
    if track is not None:
        yield track, total


def _frames(rows, name: str):
    ids, values = [], []
    for t, v in rows:
        ids.append(t)
        values.append(v)
        if len(ids) == _FOLD_ROWS:
            yield pd.DataFrame({"track_id": np.array(ids, np.int64), name: values})
            ids, values = [], []
    if ids:
        yield pd.DataFrame({"track_id": np.array(ids, np.int64), name: values})


def _normal_equations(alpha: float):
    """Rows sorted by track -> per track [sum (c-1) x x^T (rank*rank), sum c p x (rank), n positives]."""
    def parts(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            ids = pdf["track_id"].to_numpy(np.int64)
            x = np.stack(pdf["features"].to_numpy()).astype(np.float64)
            r = pdf["rating"].to_numpy(np.float64)
            c, p = 1.0 + alpha * np.abs(r), (r > 0).astype(np.float64)
            cuts = np.flatnonzero(ids[1:] != ids[:-1]) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(ids)]):
                own = x[lo:hi]
                outer = (own * (c[lo:hi] - 1.0)[:, None]).T @ own
                yield int(ids[lo]), np.concatenate(
                    [outer.ravel(), (c[lo:hi] * p[lo:hi]) @ own, [p[lo:hi].sum()]])

    def run(batches):
        yield from _frames(_summed_runs(parts(batches)), "v")
    return run


def _solve(rank: int, reg: float, gram: np.ndarray):
    """Parts sorted by track -> each track's new vector."""
    def parts(batches):
        for pdf in batches:
            for t, v in zip(pdf["track_id"], pdf["v"]):
                yield int(t), np.asarray(v, np.float64)

    def solved(batches):
        for t, v in _summed_runs(parts(batches)):
            lhs = v[:rank * rank].reshape(rank, rank) + gram + reg * max(v[-1], 1.0) * np.eye(rank)
            yield t, np.linalg.solve(lhs, v[rank * rank:-1])

    def run(batches):
        yield from _frames(solved(batches), "features")
    return run


def events_without_factor(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events that a fold-in can't use, as their user has no vector."""
    return events.join(users.select("user_id"), "user_id", "left_anti")


def fold_in_items(events: DataFrame, users: DataFrame, gram: np.ndarray,
                  rank: int, reg: float = ALS_LAMBDA, alpha: float = ALS_ALPHA,
                  pairs_per_task: int = FOLD_PAIRS) -> DataFrame:
    """M4: new item vectors from the batch's events with user factors fixed.

    One implicit-ALS half step per track (Hu, Koren, Volinsky 2008):
    (Y^T Y + Y^T (C - I) Y + lambda n I) x = Y^T C p, where Y are the user
    factors, C = 1 + alpha r and n the number of positive pairs (Spark's
    scaling of lambda). ``gram`` is Y^T Y (rank x rank, from ``gram_matrix``).
    Ratings of the same (user, track) are summed first. Users without a vector
    tell nothing about a track; ``events_without_factor`` lists their events.

    The pairs' user vectors are shuffled once by (track, part) and folded in
    sorted order, one track's equations in memory at a time. Only a track with
    more than ``pairs_per_task`` pairs has several parts, which are added up
    in a last shuffle of one row per track and part.
    """
    pairs = events.groupBy("user_id", "track_id").agg(F.sum("rating").cast("double").alias("rating"))
    hot = (pairs.groupBy("track_id").agg(F.count(F.lit(1)).alias("n"))
           .filter(F.col("n") > pairs_per_task)
           .select(reshuffled("track_id").alias("_hot"),
                   F.ceil(F.col("n") / pairs_per_task).alias("parts")))
    vectors = users.select("user_id", F.col("features").cast("array<double>").alias("features"))
    part = F.pmod(F.xxhash64("user_id"), F.coalesce("parts", F.lit(1)))
    dealt = (pairs.join(vectors, "user_id")
             .join(hot, F.col("track_id") == F.col("_hot"), "left").withColumn("part", part)
             .repartition("track_id", "part").sortWithinPartitions("track_id", "user_id"))
    parts = dealt.select("track_id", "rating", "features").mapInPandas(
        _normal_equations(alpha), "track_id long, v array<double>")
    return (parts.repartition("track_id").sortWithinPartitions("track_id")
            .mapInPandas(_solve(rank, reg, gram), "track_id long, features array<double>"))

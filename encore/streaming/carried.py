"""Item vectors folded in from batch to batch (M4 in T6), with keyed state.

Per track the state holds the sums of the normal equations and each user's
rating so far, so a batch costs what it holds and many small batches give
the vectors that one large batch gives (up to the last bits of the sums). When a user's
summed rating r changes, only the difference of that pair's terms is added:
alpha (|r'| - |r|) x x^T, and (c' p' - c p) x, and p' - p, where c = 1 + alpha |r|
and p tells r > 0.

Users of a track are dealt to ``parts`` keys, so a track with a third of a
batch is not one task; a second state adds a track's parts up and solves.
Nothing is lost with an executor: Spark keeps the state with the checkpoint.

Defined cases: a batch's ratings of one pair are summed first; users without a
vector tell nothing; events that the parser or the weights refuse are left out.
The user vectors are those of one model: a new one needs a new checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from encore.functions.parse import parse_daily
from encore.operators.model import ALS_ALPHA, ALS_LAMBDA
from encore.operators.recommend import weigh_events

PARTS = 8
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _terms(rating: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """(c p, p) of each rating."""
    positive = (rating > 0).astype(np.float64)
    return (1.0 + alpha * np.abs(rating)) * positive, positive


class PartSums(StatefulProcessor):
    """(track, part): the pairs' ratings and the sums of their terms."""

    def __init__(self, rank: int, alpha: float):
        self.rank, self.alpha = rank, alpha

    def init(self, handle) -> None:
        self.sums = handle.getValueState("sums", "v array<double>")
        self.ratings = handle.getMapState("ratings", "user_id long", "rating double")

    def handleInputRows(self, key, rows, timers) -> Iterator[pd.DataFrame]:
        v = np.array(self.sums.get()[0]) if self.sums.exists() else np.zeros(self.rank ** 2 + self.rank + 1)
        for pdf in rows:
            if pdf.empty:
                continue
            pairs = pdf.groupby("user_id").agg({"rating": "sum", "features": "first"})
            users = [int(u) for u in pairs.index]
            old = np.array([self.ratings.getValue((u,))[0] if self.ratings.containsKey((u,)) else 0.0 for u in users])
            new = old + pairs["rating"].to_numpy(np.float64)
            x = np.stack(pairs["features"].to_numpy()).astype(np.float64)
            more = self.alpha * (np.abs(new) - np.abs(old))
            (cp, p), (cp_old, p_old) = _terms(new, self.alpha), _terms(old, self.alpha)
            v += np.concatenate([((x * more[:, None]).T @ x).ravel(), (cp - cp_old) @ x, [(p - p_old).sum()]])
            for u, r in zip(users, new):
                self.ratings.updateValue((u,), (float(r),))
        self.sums.update((v.tolist(),))
        yield pd.DataFrame({"track_id": [int(key[0])], "part": [int(key[1])], "v": [v.tolist()]})

    def close(self) -> None:
        pass


class TrackVector(StatefulProcessor):
    """A track: the sums of its parts, and its vector from their total."""

    def __init__(self, rank: int, reg: float, gram: np.ndarray):
        self.rank, self.reg, self.gram = rank, reg, gram

    def init(self, handle) -> None:
        self.parts = handle.getMapState("parts", "part int", "v array<double>")

    def handleInputRows(self, key, rows, timers) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for part, v in zip(pdf["part"], pdf["v"]):
                self.parts.updateValue((int(part),), ([float(a) for a in v],))
        v = sum(np.array(value[0]) for _, value in sorted(self.parts.iterator()))
        r2 = self.rank ** 2
        lhs = v[:r2].reshape(self.rank, self.rank) + self.gram + self.reg * max(v[-1], 1.0) * np.eye(self.rank)
        yield pd.DataFrame({"track_id": [int(key[0])], "features": [np.linalg.solve(lhs, v[r2:-1]).tolist()]})

    def close(self) -> None:
        pass


@contextmanager
def state_on_disk(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which keyed state of this kind needs."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def folded_stream(lines: DataFrame, users: DataFrame, gram: np.ndarray, rank: int, reg: float = ALS_LAMBDA,
                  alpha: float = ALS_ALPHA, parts: int = PARTS) -> DataFrame:
    """Stream of daily lines -> stream of (track_id, features) of the tracks that each batch changed.

    ``users`` (user_id, features) and ``gram`` = Y^T Y come from the trainer.
    Start it inside ``state_on_disk``.
    """
    events = weigh_events(parse_daily(lines)).select(
        F.col("user_id").cast("bigint").alias("user_id"), F.col("track_id").cast("bigint").alias("track_id"),
        F.col("weight").cast("double").alias("rating"))
    vectors = users.select(F.col("user_id").cast("bigint").alias("user_id"),
                           F.col("features").cast("array<double>").alias("features"))
    dealt = events.join(vectors, "user_id").withColumn("part", F.pmod(F.xxhash64("user_id"), F.lit(parts)).cast("int"))
    sums = dealt.groupBy("track_id", "part").transformWithStateInPandas(
        PartSums(rank, alpha), "track_id long, part int, v array<double>", "Append", "None")
    return sums.groupBy("track_id").transformWithStateInPandas(
        TrackVector(rank, reg, gram), "track_id long, features array<double>", "Append", "None")


def latest_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(track_id, features): each track's newest vector of those written by batch under ``path``."""
    try:
        rows = spark.read.schema("track_id long, features array<double>, batch_id long").parquet(path)
    except AnalysisException as missing:  # no batch has been written yet
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "track_id long, features array<double>")
    return rows.groupBy("track_id").agg(F.max_by("features", "batch_id").alias("features"))

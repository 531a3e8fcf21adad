"""Shuffle files go when what they were written for is there: writes that are read back, iterations of ALS."""

import gc
import glob
import time

import numpy as np
from pyspark.sql import functions as F

from encore.operators import model
from encore.sinks.files import materialize


def shuffle_files(spark) -> set[str]:
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}


def gone(spark, before: set[str], within: float = 20.0) -> bool:
    end = time.time() + within
    while time.time() < end:
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.2)
    return False


def test_a_table_that_is_read_back_leaves_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffle_files(spark), spark.conf.get(setting, None)
    table = materialize(spark, spark.range(10000).groupBy((F.col("id") % 100).alias("k")).count(), "counted")
    assert gone(spark, before)
    assert table.count() == 100
    assert spark.conf.get(setting, None) == was


def test_shuffles_out_of_reach_go_while_the_block_runs(spark):
    before = shuffle_files(spark)
    with model.unreachable_removed(spark, every=0.2):
        spark.range(10000).groupBy((F.col("id") % 100).alias("k")).count().collect()
        gc.collect()  # Python's references to the plan
        assert gone(spark, before)


def test_checkpoints_come_sooner_where_iterations_shuffle_more(spark, monkeypatch):
    assert model.iterations_kept(100_000, 40, 10) == 10
    assert model.iterations_kept(1_000_000, 40, 10) == 3
    assert model.iterations_kept(100_000_000, 40, 10) == 1
    assert model.iterations_kept(100_000_000, 40, -1) == -1  # no checkpoints
    assert model.iterations_kept(0, 40, 10) == 10
    ratings = materialize(spark, spark.range(400).select(
        (F.col("id") % 20).cast("int").alias("user_id"), (F.col("id") % 23).cast("int").alias("track_id"),
        (1 + F.col("id") % 5).cast("double").alias("rating")), "some_ratings")

    def factors():
        rows = model.item_factors(model.train_implicit_als(ratings, rank=3, iterations=5, blocks=2)).collect()
        return np.array([r.features for r in sorted(rows)])

    seen = []
    als = model.ALS
    monkeypatch.setattr(model, "ALS", lambda **given: seen.append(given["checkpointInterval"]) or als(**given))
    late = factors()
    monkeypatch.setattr(model, "KEPT_BYTES", 1)
    np.testing.assert_allclose(factors(), late, atol=1e-4)
    assert seen == [10, 1]

"""Vectors carried from batch to batch: many small batches give what one large one gives."""

import numpy as np
from pyspark.sql import functions as F

from encore import jobs
from encore.functions.parse import to_als_rating
from encore.operators import aggregates as agg
from encore.operators.model import fold_in_items, train_implicit_als, user_factors
from encore.operators.recommend import weigh_events
from encore.session import scratch_path
from encore.sinks.files import materialize, write_table
from encore.sources import testdata as td
from encore.sources.line_log import line_log
from encore.sources.text import to_daily_lines
from encore.streaming import carried
from tests.conftest import SF_SMALL


def test_small_batches_equal_one_large_one(spark):
    model = train_implicit_als(materialize(spark, to_als_rating(td.acc(spark, SF_SMALL)), "c_ratings"), rank=4, iterations=2)
    users = write_table(user_factors(model), scratch_path(spark, "c_users"))
    gram = write_table(agg.gram_matrix(spark.read.parquet(users), 4), scratch_path(spark, "c_gram"))
    folder, out, ckpt = (scratch_path(spark, name) for name in ("c_log", "c_out", "c_ckpt"))
    plays = td.plays(spark, SF_SMALL)
    for part in range(3):  # users play a track in several batches
        to_daily_lines(plays.filter(F.col("event_id") % 3 == part)).write.mode("append").text(folder)
        jobs.run_fold_in(spark, users, gram, out, ckpt, line_log(spark, folder), available_now=True)
    got = {r.track_id: np.array(r.features) for r in carried.latest_vectors(spark, out).collect()}
    rows = spark.read.schema("track_id long, features array<double>, batch_id long").parquet(out)
    assert {r.batch_id for r in rows.select("batch_id").distinct().collect()} == {0, 1, 2}
    ratings = weigh_events(plays).select("user_id", "track_id", F.col("weight").alias("rating"))
    vectors = spark.read.parquet(users)
    matrix = agg.as_array(spark.read.parquet(gram), 4)
    want = {r.track_id: np.array(r.features) for r in fold_in_items(ratings, vectors, matrix, 4).collect()}
    assert got.keys() == want.keys() and len(want) > 10
    for track, vector in want.items():
        np.testing.assert_allclose(got[track], vector, rtol=1e-7, atol=1e-10)


def test_no_batch_yet(spark):
    assert carried.latest_vectors(spark, scratch_path(spark, "none")).collect() == []

"""Weights, merges, top-N ties and the literal formulas (FIXTURES 3)."""

import math

from pyspark.sql import functions as F

from encore.functions.bucket import hash_bucket, range_bucket
from encore.functions.score import diversity_ratio
from encore.operators.merge import latest_rating, merge_prev_recs, merge_ratings
from encore.operators.recommend import weigh_events
from encore.operators.topn import user_top_n


def test_weights(spark):
    df = spark.createDataFrame([(r, 2.5) for r in ["query", "rec", "browsing", "radio",
                                                   "unknown"]],
                               "reason_start string, ms_played double")
    got = {r.reason_start: float(r.weight) for r in weigh_events(df).collect()}
    assert got == {"query": 25.0, "rec": 12.5, "browsing": 12.5, "radio": 7.5}


def test_merge(spark):
    acc = spark.createDataFrame([(1, 7, 100, 4.0), (1, 8, 100, 2.0)],
                                "user_id long, track_id long, ts long, rating double")
    day = spark.createDataFrame([(1, 7, 200, 3.0), (1, 7, 150, 1.0), (2, 7, 160, 5.0)],
                                "user_id long, track_id long, ts long, score double")
    got = sorted(tuple(r) for r in merge_ratings(acc, day)
                 .select("user_id", "track_id", "ts", "rating").collect())
    assert got == [(1, 7, 200, 8.0), (1, 8, 100, 2.0), (2, 7, 160, 5.0)]


def test_latest_rating_ties_by_rating(spark):
    df = spark.createDataFrame([(1, 7, 100, 4.0), (1, 7, 200, 1.0), (1, 7, 200, 3.0)],
                               "user_id long, track_id long, ts long, rating double")
    assert [tuple(r) for r in latest_rating(df).collect()] == [(1, 7, 200, 3.0)]


def test_top_n_ties_and_direction(spark):
    df = spark.createDataFrame([(1, 10, 4.0), (1, 11, 9.0), (1, 12, 9.0), (1, 13, 1.0)],
                               "user_id long, track_id long, score double")
    desc = [r.track_id for r in user_top_n(df, 2).orderBy("rank").collect()]
    asc = [r.track_id for r in user_top_n(df, 2, ascending=True).orderBy("rank").collect()]
    assert desc == [11, 12] and asc == [13, 10]


def test_merge_prev_recs_keeps_best(spark):
    today = spark.createDataFrame([(1, 5, 2.0), (1, 6, 1.0)], "user_id long, track_id long, score double")
    prev = spark.createDataFrame([(1, 5, 3.0), (2, 9, 1.0)], "user_id long, track_id long, score double")
    def run(**kw):
        return sorted((r.user_id, r.track_id, float(r.score))
                      for r in merge_prev_recs(today, prev, **kw).collect())
    # earlier lists are refreshed for today's users only, unless asked for all
    assert run() == [(1, 5, 3.0), (1, 6, 1.0)]
    assert run(today_users_only=False) == [(1, 5, 3.0), (1, 6, 1.0), (2, 9, 1.0)]


def test_literal_diversity_ratio(spark):
    df = spark.createDataFrame([(12000000, 4.0), (5, 0.0), (0, 0.0)],
                               "user_id long, score double")
    guarded = [r[0] for r in df.select(diversity_ratio(F.col("user_id"), F.col("score"))).collect()]
    literal = [r[0] for r in df.select(diversity_ratio(F.col("user_id"), F.col("score"),
                                                       literal=True)).collect()]
    assert guarded == [3000000.0, None, None]
    assert literal[0] == 3000000.0 and literal[1] == math.inf and math.isnan(literal[2])


def test_buckets(spark):
    df = spark.createDataFrame([(0,), (5999999,), (6000000,), (59999999,), (7,)], "user_id long")
    got = [(r[0], r[1]) for r in df.select(range_bucket(F.col("user_id")),
                                           hash_bucket(F.col("user_id"))).collect()]
    assert got == [(0, 1), (0, 4), (1, 1), (9, 4), (0, 4)]

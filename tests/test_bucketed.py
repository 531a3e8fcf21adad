"""The bucketed upsert: same rows as the merge, and nothing moves but the day."""

import math
import os
import re

from pyspark.sql import functions as F

from encore.operators.merge import merge_ratings
from encore.operators.recommend import weigh_events
from encore.session import scratch_path
from encore.sinks import bucketed
from encore.sources import testdata as td
from encore.sources.text import scan_lines, to_rating_lines, write_lines
from encore.functions.parse import parse_ratings
from tests.conftest import SF_MID


def depth(line):
    return re.search(r"[A-Za-z]", line).start()


def under_exchange(plan, leaf):
    """Whether an exchange stands above a leaf of a plan's tree text."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if leaf in line)
    level = depth(lines[at])
    for line in reversed(lines[:at]):
        if re.search(r"[A-Za-z]", line) and depth(line) < level:
            level = depth(line)
            if "Exchange" in line:
                return True
    return False


def day_scores(spark):
    return weigh_events(td.daily(spark, SF_MID)).withColumnRenamed("weight", "score")


def test_only_the_day_is_shuffled(spark):
    path = bucketed.write_ratings(td.acc(spark, SF_MID), scratch_path(spark, "ratings"), 6)
    plan = bucketed.upserted(spark, path, day_scores(spark))._jdf.queryExecution().executedPlan().toString()
    name = bucketed._named(path)
    assert name in plan and "SortMergeJoin" in plan
    assert not under_exchange(plan, name)
    assert under_exchange(plan, "events.parquet")


def test_upserts_equal_merges(spark):
    acc, day = td.acc(spark, SF_MID), day_scores(spark)
    path = bucketed.write_ratings(acc, scratch_path(spark, "ratings"), 6)
    new = bucketed.upsert(spark, path, day, scratch_path(spark, "ratings"))
    rows = lambda df: sorted(map(tuple, df.collect()))
    merged = merge_ratings(acc, day)
    assert rows(bucketed.read(spark, new)) == rows(merged)
    files = [f for f in os.listdir(new.removeprefix("file:")) if f.endswith(".parquet")]
    assert len(files) == bucketed.buckets_of(spark, new) == 6
    again = bucketed.upsert(spark, new, day, scratch_path(spark, "ratings"))
    assert rows(bucketed.read(spark, again)) == rows(merge_ratings(merged, day))


def test_no_bit_of_a_rating_is_lost(spark):
    acc = spark.createDataFrame([(1, 1, None, 0.1), (2, 1, None, 1e25), (3, 3, None, 1e-9)],
                                "user_id long, track_id long, ts timestamp_ntz, rating double")
    day = spark.createDataFrame([(1, 1, None, 0.2), (1, 1, None, 1e-12), (2, 1, None, 3.0), (9, 9, None, 5e11)],
                                "user_id long, track_id long, ts timestamp_ntz, score double")
    want = {(1, 1): math.fsum([0.1, 0.2, 1e-12]), (2, 1): math.fsum([1e25, 3.0]), (3, 3): 1e-9, (9, 9): 5e11}
    path = bucketed.write_ratings(acc, scratch_path(spark, "ratings"), 2)
    for out in (merge_ratings(acc, day), bucketed.upserted(spark, path, day)):
        assert {(r.user_id, r.track_id): r.rating for r in out.collect()} == want
    stamped = merge_ratings(acc, day).withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    lines = write_lines(to_rating_lines(stamped), scratch_path(spark, "exact_lines"))
    assert {(r.user_id, r.track_id): r.rating for r in parse_ratings(scan_lines(spark, lines)).collect()} == want


def test_double_play_times_keep_their_size(spark):
    plays = spark.createDataFrame([(1, 1, 12345678901234.5, "rec"), (1, 2, 1e-7, "query"), (1, 3, 1.0, "?"), (1, 4, 1e308, "query")],
                                  "user_id long, track_id long, ms_played double, reason_start string")
    assert {r.track_id: r.weight for r in weigh_events(plays, doubles=True).collect()} == {1: 61728394506172.5, 2: 1e-6}

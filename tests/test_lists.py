"""Lists per key in parts (J2, A1), against the rows they were made from."""

from collections import Counter

from pyspark.sql import functions as F

from encore.operators.lists import co_listed, track_event_lists, user_lists


def exploded(df, key, side):
    rows = df.select(key, F.explode(side).alias("e")).select(key, "e.*").collect()
    out = Counter()
    for r in rows:
        out[tuple(r)[:-1]] += r.times
    return out


def test_a_hot_user_spreads_over_parts(spark):
    events = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50).cast("long").alias("user_id"),
        (F.col("id") % 997).alias("track_id"), F.timestamp_seconds("id").alias("ts"),
        (F.col("id") % 7).cast("double").alias("weight"))
    ratings = events.filter("user_id < 40").groupBy("user_id", "track_id").agg(
        F.max("ts").alias("ts"), F.sum("weight").alias("rating"))
    got = user_lists(ratings, events, part_rows=100).cache()
    assert exploded(got, "user_id", "ratings") == Counter(map(tuple, ratings.collect()))
    want = events.filter("user_id < 40").select("user_id", "track_id", "ts", "weight")
    assert exploded(got, "user_id", "events") == Counter(map(tuple, want.collect()))
    hot = got.filter("user_id = 1").select("part", "n_parts", (F.size("ratings") + F.size("events")).alias("n")).collect()
    assert len(hot) == hot[0].n_parts > 20 and max(r.n for r in hot) < 200
    assert got.groupBy("user_id", "part").count().filter("count > 1").isEmpty()


def test_repeated_rows_are_one_element(spark):
    events = spark.createDataFrame([(5, 1, 10, 2.0)] * 500 + [(None, 1, 10, 2.0), (6, None, None, None)] * 2,
                                   "track_id long, user_id long, ts long, weight double")
    got = track_event_lists(events, part_rows=10)
    rows = {r.track_id: (r.part, r.n_parts, [tuple(e) for e in r.events]) for r in got.collect()}
    assert rows[5][1:] == (1, [(1, 10, 2.0, 500)])
    assert rows[None][2] == [(1, 10, 2.0, 2)] and rows[6][2] == [(None, None, None, 2)]


def test_empty_and_missing_sides(spark):
    none = spark.createDataFrame([], "k long, v long")
    some = spark.createDataFrame([(1, 2)], "k long, v long")
    assert co_listed("k", {"a": none, "b": none}).collect() == []
    assert co_listed("k", {"a": none, "b": some}, needs="a").collect() == []
    row = co_listed("k", {"a": none, "b": some}).first()
    assert row.a == [] and [tuple(e) for e in row.b] == [(2, 1)]
    plan = co_listed("k", {"a": some, "b": some})._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan

"""Registry of the queries exposed through ``__spark_entry__.queries()``.

Each entry takes (spark, sf_dir) and returns a DataFrame computed over the
whole test tables. Computed columns carry the same names as in
``encore.oracle``; decimals leave as DOUBLE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions.bucket import hash_bucket, range_bucket
from encore.functions.parse import (parse_daily, parse_daily_lines, parse_ratings,
                                    quarantine, to_als_rating)
from encore.functions.score import diversity_ratio, rec_score
from encore.functions.vector import rounded_similarity
from encore.operators import aggregates as agg
from encore.operators import cells
from encore.operators import filters as flt
from encore.operators.joins import broadcast_if_bounded
from encore.operators.merge import (latest_rating, merge_prev_recs, merge_ratings,
                                    user_ratings_and_events)
from encore.operators.lists import track_event_lists, user_lists
from encore.operators.partitions import parse_daily_in_pandas, step_counts
from encore.operators.recommend import diversity_reweight, event_candidates, weigh_events
from encore.operators.similar import similar_tracks as _similar_tracks
from encore.operators.topn import user_top_n
from encore.plans import batch, training
from encore.session import scratch_path
from encore.sinks import bucketed, keyed
from encore.sinks.files import (materialize, read_user_recs, write_rating_lines,
                                write_user_recs)
from encore.sources import testdata as td
from encore.sources.line_log import line_log
from encore.sources.text import scan_lines, to_daily_lines, to_rating_lines, write_lines
from encore.streaming import carried, process, recommender, source, window

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

N = batch.DEFAULT_N
K = batch.DEFAULT_K


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _dbl(name: str):
    return F.col(name).cast("double").alias(name)


# ---------------------------------------------------------------- shared steps

def _daily_lines_dir(spark, sf_dir) -> str:
    lines = to_daily_lines(td.plays(spark, sf_dir))
    return write_lines(lines, scratch_path(spark, "daily_lines"))


def _rating_lines_dir(spark, sf_dir) -> str:
    lines = to_rating_lines(td.acc(spark, sf_dir))
    return write_lines(lines, scratch_path(spark, "rating_lines"))


def _index(spark, sf_dir) -> batch.SimilarIndex:
    return batch.build_index(td.vectors(spark, sf_dir), K)


def _today_candidates(spark, sf_dir, index=None) -> DataFrame:
    index = index or _index(spark, sf_dir)
    return event_candidates(weigh_events(td.daily(spark, sf_dir)), index.table, index.rows_bound)


def _today_top(spark, sf_dir, index) -> DataFrame:
    return batch.candidate_recs(td.daily(spark, sf_dir), index, td.dismissals(spark, sf_dir), N)


def _recent_history(spark, sf_dir) -> DataFrame:
    return flt.filter_recent(td.history(spark, sf_dir), td.HISTORY_AS_OF)


# ---------------------------------------------------------------- sources

@query("scan_daily_lines")
def q_scan_daily_lines(spark, sf_dir):
    return scan_lines(spark, _daily_lines_dir(spark, sf_dir) + "/part-*")


@query("scan_rating_lines")
def q_scan_rating_lines(spark, sf_dir):
    return scan_lines(spark, _rating_lines_dir(spark, sf_dir) + "/part-*")


@query("track_vector_lookup")
def q_track_vector_lookup(spark, sf_dir):
    vec = td.vectors(spark, sf_dir)
    bound = vec.count()
    joined = td.plays(spark, sf_dir).join(broadcast_if_bounded(vec, bound), "track_id")
    return joined.select("event_id", "user_id", "track_id", "label",
                         F.size("features").alias("n_dims"),
                         F.col("features")[0].alias("first_component"))


# ---------------------------------------------------------------- parsing

@query("parse_daily")
def q_parse_daily(spark, sf_dir):
    return parse_daily(scan_lines(spark, _daily_lines_dir(spark, sf_dir)))


@query("parse_ratings")
def q_parse_ratings(spark, sf_dir):
    return parse_ratings(scan_lines(spark, _rating_lines_dir(spark, sf_dir)))


@query("parse_quarantine")
def q_parse_quarantine(spark, sf_dir):
    """A mixed feed (daily and rating lines) read with the daily parser."""
    mixed = scan_lines(spark, [_daily_lines_dir(spark, sf_dir), _rating_lines_dir(spark, sf_dir)])
    return quarantine(parse_daily_lines(mixed))


@query("map_partitions")
def q_map_partitions(spark, sf_dir):
    return parse_daily_in_pandas(scan_lines(spark, _daily_lines_dir(spark, sf_dir)))


@query("to_als_rating")
def q_to_als_rating(spark, sf_dir):
    return to_als_rating(td.acc(spark, sf_dir))


# ---------------------------------------------------------------- scores

@query("event_weight")
def q_event_weight(spark, sf_dir):
    w = weigh_events(td.plays(spark, sf_dir))
    return w.select("event_id", "user_id", "track_id", "reason_start", _dbl("weight"))


@query("cosine_similarity")
def q_cosine_similarity(spark, sf_dir):
    """P10 as a SQL expression on the similar-track pairs."""
    vec = td.vectors(spark, sf_dir)
    n = vec.count()
    sim = _similar_tracks(vec, k=K, n_vectors=n).select("track_id", "similar_track_id")
    a = broadcast_if_bounded(vec.select("track_id", F.col("features").alias("fa")), n)
    b = broadcast_if_bounded(vec.select(F.col("track_id").alias("similar_track_id"),
                                        F.col("features").alias("fb")), n)
    return (sim.join(a, "track_id").join(b, "similar_track_id")
            .select("track_id", "similar_track_id",
                    rounded_similarity(F.col("fa"), F.col("fb")).alias("similarity")))


@query("explode_events")
def q_explode_events(spark, sf_dir):
    """Every play with each of its track's similar tracks attached."""
    index = _index(spark, sf_dir)
    sim = broadcast_if_bounded(index.table, index.rows_bound)
    return (td.plays(spark, sf_dir).join(sim, "track_id")
            .select("event_id", "user_id", "track_id", "similar_track_id",
                    _dbl("similarity")))


@query("rec_score")
def q_rec_score(spark, sf_dir):
    """P9 per event and candidate: similarity x event weight."""
    index = _index(spark, sf_dir)
    sim = broadcast_if_bounded(index.table, index.rows_bound)
    w = weigh_events(td.daily(spark, sf_dir))
    return (w.join(sim, "track_id")
            .select("event_id", "user_id", "similar_track_id",
                    rec_score(F.col("similarity"), F.col("weight")).alias("score")))


@query("event_candidates")
def q_event_candidates(spark, sf_dir):
    return _today_candidates(spark, sf_dir).select("user_id", "track_id", _dbl("score"))


@query("diversity_ratio")
def q_diversity_ratio(spark, sf_dir):
    top = _today_top(spark, sf_dir, _index(spark, sf_dir))
    return top.select("user_id", "track_id",
                      diversity_ratio(F.col("user_id"), F.col("score")).alias("ratio"))


@query("diversity_reweight")
def q_diversity_reweight(spark, sf_dir):
    index = _index(spark, sf_dir)
    div = diversity_reweight(_today_top(spark, sf_dir, index), index.labels, index.n_vectors)
    return div.select("user_id", "track_id", "label", "label_rank", "base_score", "score")


@query("user_bucket")
def q_user_bucket(spark, sf_dir):
    users = td.history(spark, sf_dir).select("user_id").distinct()
    return users.select("user_id", range_bucket(F.col("user_id"), 100).alias("range_bucket"),
                        hash_bucket(F.col("user_id")).alias("hash_bucket"))


# ---------------------------------------------------------------- filters (F1-F8)

@query("filter_recent")
def q_filter_recent(spark, sf_dir):
    return _recent_history(spark, sf_dir)


@query("filter_active_tracks")
def q_filter_active_tracks(spark, sf_dir):
    return flt.filter_active_tracks(_recent_history(spark, sf_dir), td.HISTORY_AS_OF, mode="any")


@query("filter_active_tracks_all")
def q_filter_active_tracks_all(spark, sf_dir):
    return flt.filter_active_tracks(_recent_history(spark, sf_dir), td.HISTORY_AS_OF, mode="all")


@query("filter_active_users")
def q_filter_active_users(spark, sf_dir):
    return flt.filter_active_users(_recent_history(spark, sf_dir), min_ratings=10)


@query("filter_dismissed")
def q_filter_dismissed(spark, sf_dir):
    kept = flt.filter_dismissed(_today_candidates(spark, sf_dir), td.dismissals(spark, sf_dir))
    return kept.select("user_id", "track_id", _dbl("score"))


@query("sample_users")
def q_sample_users(spark, sf_dir):
    return flt.sample_users(td.history(spark, sf_dir), 100)


@query("events_of_user")
def q_events_of_user(spark, sf_dir):
    return flt.events_of_user(td.plays(spark, sf_dir), 42).select(
        "event_id", "user_id", "track_id", "ts", _dbl("ms_played"), "reason_start")


# ---------------------------------------------------------------- joins and merges

@query("merge_ratings")
def q_merge_ratings(spark, sf_dir):
    scores = weigh_events(td.daily(spark, sf_dir)).withColumnRenamed("weight", "score")
    return merge_ratings(td.acc(spark, sf_dir), scores)


@query("upsert_ratings")
def q_upsert_ratings(spark, sf_dir):
    """J1 on the bucketed table: the accumulated side is neither shuffled to merge nor to write."""
    scores = weigh_events(td.daily(spark, sf_dir)).withColumnRenamed("weight", "score")
    table = bucketed.write_ratings(td.acc(spark, sf_dir), scratch_path(spark, "ratings_table"), 8)
    return bucketed.read(spark, bucketed.upsert(spark, table, scores, scratch_path(spark, "ratings_table")))


@query("latest_rating")
def q_latest_rating(spark, sf_dir):
    return latest_rating(td.history(spark, sf_dir))


@query("user_ratings_and_events")
def q_user_ratings_and_events(spark, sf_dir):
    return user_ratings_and_events(td.acc(spark, sf_dir), weigh_events(td.daily(spark, sf_dir)))


@query("user_lists")
def q_user_lists(spark, sf_dir):
    """J2 as lists, exploded: one row per element."""
    lists = user_lists(td.acc(spark, sf_dir), weigh_events(td.daily(spark, sf_dir)))
    one = lambda side, value: lists.select(
        "user_id", F.lit(side).alias("side"), F.explode(side).alias("e")).select(
        "user_id", "side", "e.track_id", "e.ts", F.col(f"e.{value}").cast("double").alias("value"), "e.times")
    return one("ratings", "rating").unionByName(one("events", "weight"))


@query("merge_prev_recs")
def q_merge_prev_recs(spark, sf_dir):
    index = _index(spark, sf_dir)
    prev = batch.previous_recs(spark, sf_dir, index)
    merged = merge_prev_recs(_today_top(spark, sf_dir, index), prev)
    return merged.select("user_id", "track_id", _dbl("score"))


# ---------------------------------------------------------------- aggregates

@query("events_by_track")
def q_events_by_track(spark, sf_dir):
    out = agg.events_by_track(weigh_events(td.plays(spark, sf_dir)))
    return out.select("track_id", "n_events", _dbl("weight_sum"), "last_ts")


@query("track_event_lists")
def q_track_event_lists(spark, sf_dir):
    """A1 as lists, exploded: one row per element."""
    lists = track_event_lists(weigh_events(td.plays(spark, sf_dir)))
    return lists.select("track_id", F.explode("events").alias("e")).select(
        "track_id", "e.user_id", "e.ts", F.col("e.weight").cast("double").alias("weight"), "e.times")


@query("track_activity")
def q_track_activity(spark, sf_dir):
    return agg.track_activity(_recent_history(spark, sf_dir))


@query("user_activity")
def q_user_activity(spark, sf_dir):
    return agg.user_activity(_recent_history(spark, sf_dir))


@query("recs_by_user")
def q_recs_by_user(spark, sf_dir):
    recs = agg.recs_by_user(batch.batch_recommendations(spark, sf_dir), N)
    return recs.select("user_id", F.size("recs").alias("n_recs"),
                       F.col("recs")[0]["track_id"].alias("first_track_id"),
                       F.aggregate("recs", F.lit(0.0), lambda a, r: a + r["score"])
                       .alias("score_sum"))


@query("gram_matrix")
def q_gram_matrix(spark, sf_dir):
    g = agg.gram_matrix(td.vectors(spark, sf_dir), dim=64)
    return g.select("i", "j", F.round("value", 6).alias("value"))


@query("stage_counts")
def q_stage_counts(spark, sf_dir):
    """Rows after each step of today's list, observed in one pass (no extra jobs)."""
    from pyspark.sql import Observation
    index = _index(spark, sf_dir)
    names = ["weighted_events", "candidates", "not_dismissed", "top_n"]
    obs = {name: Observation(name) for name in names}

    def seen(df, name):
        return df.observe(obs[name], F.count(F.lit(1)).alias("n_rows"))
    weighted = seen(weigh_events(td.daily(spark, sf_dir)), "weighted_events")
    cands = seen(event_candidates(weighted, index.table, index.rows_bound), "candidates")
    kept = seen(flt.filter_dismissed(cands, td.dismissals(spark, sf_dir)), "not_dismissed")
    seen(user_top_n(kept, N), "top_n").write.format("noop").mode("overwrite").save()
    counts = [(name, int(obs[name].get["n_rows"])) for name in names]  # four numbers
    return spark.createDataFrame(counts, "stage string, n_rows long")


@query("partition_counts")
def q_partition_counts(spark, sf_dir):
    """Lines, good events and weighted events, counted by partition and added up."""
    parsed = parse_daily_lines(scan_lines(spark, [_daily_lines_dir(spark, sf_dir), _rating_lines_dir(spark, sf_dir)]))
    good = F.col("parse_error").isNull()
    weighed = weigh_events(parsed, mode="keep")
    counts = step_counts(weighed, {"lines": F.lit(True), "events": good,
                                   "weighted_events": good & F.col("weight").isNotNull()})
    return counts.groupBy("step").agg(F.sum("n_rows").alias("n_rows"))


# ---------------------------------------------------------------- top-N

@query("user_top_n")
def q_user_top_n(spark, sf_dir):
    top = _today_top(spark, sf_dir, _index(spark, sf_dir))
    return top.select("user_id", "rank", "track_id", _dbl("score"))


@query("user_top_n_asc")
def q_user_top_n_asc(spark, sf_dir):
    index = _index(spark, sf_dir)
    top = batch.candidate_recs(td.daily(spark, sf_dir), index, td.dismissals(spark, sf_dir), N,
                               ascending=True)
    return top.select("user_id", "rank", "track_id", _dbl("score"))


@query("user_top_n_final")
def q_user_top_n_final(spark, sf_dir):
    return batch.batch_recommendations(spark, sf_dir, n=10)


@query("batch_recommendations")
def q_batch_recommendations(spark, sf_dir):
    return batch.batch_recommendations(spark, sf_dir)


@query("similar_tracks")
def q_similar_tracks(spark, sf_dir):
    sim = _similar_tracks(td.vectors(spark, sf_dir), k=K)
    return sim.select("track_id", "rank", "similar_track_id", _dbl("similarity"),
                      "similar_label")


# ---------------------------------------------------------------- sinks (K1-K4)

@query("sink_user_recs")
def q_sink_user_recs(spark, sf_dir):
    recs = batch.batch_recommendations(spark, sf_dir)
    path = write_user_recs(recs, scratch_path(spark, "user_recs"), N)
    return read_user_recs(spark, path)


@query("sink_merged_ratings")
def q_sink_merged_ratings(spark, sf_dir):
    scores = weigh_events(td.daily(spark, sf_dir)).withColumnRenamed("weight", "score")
    merged = merge_ratings(td.acc(spark, sf_dir), scores)
    path = write_rating_lines(merged, scratch_path(spark, "merged_ratings"))
    return parse_ratings(scan_lines(spark, path))


# ---------------------------------------------------------------- model (M1-M4)

@query("training_ratings")
def q_training_ratings(spark, sf_dir):
    return training.history_training_ratings(spark, sf_dir)


@query("als_item_factors")
def q_als_item_factors(spark, sf_dir):
    return training.item_factor_summary(training.train_item_factors(spark, sf_dir))


@query("als_item_ids")
def q_als_item_ids(spark, sf_dir):
    return training.train_item_factors(spark, sf_dir, rank=8, iterations=5).select("track_id")


# ---------------------------------------------------------------- streaming

def _event_stream(spark, sf_dir):
    schema = td.table(spark, sf_dir, "events").schema
    return source.file_events(spark, f"{sf_dir.rstrip('/')}/event[s].parquet", schema)


def _run_lines_stream(spark, lines: DataFrame, transform, name: str) -> str:
    out = scratch_path(spark, name)
    process.run_stream(lines, process.batch_dir_writer(out, transform),
                       scratch_path(spark, name + "_checkpoint"))
    return out


@query("stream_scan")
def q_stream_scan(spark, sf_dir):
    lines = source.event_lines(_event_stream(spark, sf_dir))
    out = _run_lines_stream(spark, lines, lambda df, _id: parse_daily(df), "stream_scan")
    return spark.read.parquet(out).drop("batch_id")


@query("stream_sink_batches")
def q_stream_sink_batches(spark, sf_dir):
    lines = source.event_lines(_event_stream(spark, sf_dir))
    out = _run_lines_stream(spark, lines, lambda df, _id: parse_daily(df), "stream_sink")
    return spark.read.parquet(out)


@query("stream_restart")
def q_stream_restart(spark, sf_dir):
    """A second run on the same checkpoint finds nothing new to write."""
    out, ckpt = scratch_path(spark, "stream_restart"), scratch_path(spark, "stream_restart_ckpt")
    for _ in range(2):
        lines = source.event_lines(_event_stream(spark, sf_dir))
        process.run_stream(lines, process.batch_dir_writer(out, lambda df, _id: parse_daily(df)),
                           ckpt)
    return spark.read.parquet(out)


@query("stream_union")
def q_stream_union(spark, sf_dir):
    ev = _event_stream(spark, sf_dir)
    first = ev.filter(F.col("event_type").isin("purchase", "click"))
    rest = ev.filter(~F.col("event_type").isin("purchase", "click"))
    lines = source.union_streams(source.event_lines(first), source.event_lines(rest))
    out = _run_lines_stream(spark, lines, lambda df, _id: parse_daily(df), "stream_union")
    return spark.read.parquet(out).drop("batch_id")


@query("stream_event_weight")
def q_stream_event_weight(spark, sf_dir):
    lines = source.event_lines(_event_stream(spark, sf_dir))

    def transform(df, _id):
        w = weigh_events(parse_daily(df))
        return w.select("user_id", "track_id", "ts", "reason_start", _dbl("weight"))
    return spark.read.parquet(_run_lines_stream(spark, lines, transform, "stream_weight")) \
        .drop("batch_id")


@query("stream_events_by_track")
def q_stream_events_by_track(spark, sf_dir):
    lines = source.event_lines(_event_stream(spark, sf_dir))

    def transform(df, _id):
        out = agg.events_by_track(weigh_events(parse_daily(df)))
        return out.select("track_id", "n_events", _dbl("weight_sum"), "last_ts")
    return spark.read.parquet(_run_lines_stream(spark, lines, transform, "stream_by_track")) \
        .drop("batch_id")


@query("stream_line_log")
def q_stream_line_log(spark, sf_dir):
    """Line files that grow, read by offset; three runs on one checkpoint, one batch each."""
    folder, out = scratch_path(spark, "line_log"), scratch_path(spark, "line_log_out")
    checkpoint = scratch_path(spark, "line_log_checkpoint")

    def transform(df, _id):
        found = agg.events_by_track(weigh_events(parse_daily(df)))
        return found.select("track_id", "n_events", _dbl("weight_sum"), "last_ts")
    for part in range(3):
        mine = td.plays(spark, sf_dir).filter(F.col("event_id") % 3 == part)
        to_daily_lines(mine).write.mode("append").text(folder)
        process.run_stream(line_log(spark, folder), process.batch_dir_writer(out, transform), checkpoint)
    return spark.read.parquet(out)


@query("stream_track_window")
def q_stream_track_window(spark, sf_dir):
    """T5: 1-day event-time windows per track, watermark 1 hour, update mode."""
    plays = weigh_events(td.plays_from_events(_event_stream(spark, sf_dir)))
    windows = window.track_windows(plays, "1 day", "1 hour")
    out, ckpt = scratch_path(spark, "stream_window"), scratch_path(spark, "stream_window_ckpt")
    q = (windows.writeStream.outputMode("update")
         .foreachBatch(process.batch_dir_writer(out, lambda df, _id: df))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.read.parquet(out)
    latest = rows.groupBy("window_start", "track_id").agg(
        F.max_by(F.struct("n_events", "weight_sum"), "batch_id").alias("v"))
    return latest.select("window_start", "track_id", "v.n_events",
                         F.col("v.weight_sum").cast("double").alias("weight_sum"))


@query("stream_user_top_n")
def q_stream_user_top_n(spark, sf_dir):
    index = _index(spark, sf_dir)
    lines = source.event_lines(_event_stream(spark, sf_dir))
    dismissals = materialize(spark, td.dismissals(spark, sf_dir), "dismissals")
    transform = recommender.top_n_transform(index, dismissals, N)
    return spark.read.parquet(_run_lines_stream(spark, lines, transform, "stream_top_n")) \
        .drop("batch_id")


@query("stream_recommendations")
def q_stream_recommendations(spark, sf_dir):
    index = _index(spark, sf_dir)
    prev = materialize(spark, batch.previous_recs(spark, sf_dir, index), "previous_recs")
    lines = source.event_lines(_event_stream(spark, sf_dir))
    dismissals = materialize(spark, td.dismissals(spark, sf_dir), "dismissals")
    transform = recommender.recommend_transform(index, dismissals, prev, N)
    return spark.read.parquet(_run_lines_stream(spark, lines, transform, "stream_recs")) \
        .drop("batch_id")


@query("stream_recommendations_keyed")
def q_stream_recommendations_keyed(spark, sf_dir):
    """T6 with the dismissals and earlier recs laid out by user: a batch reads its users' buckets."""
    index = _index(spark, sf_dir)
    prev = keyed.write_by_user(batch.previous_recs(spark, sf_dir, index), scratch_path(spark, "previous_recs"), 16)
    dismissals = keyed.write_by_user(td.dismissals(spark, sf_dir), scratch_path(spark, "dismissals"), 16)
    lines = source.event_lines(_event_stream(spark, sf_dir))
    transform = recommender.recommend_transform(index, dismissals, prev, N)
    return spark.read.parquet(_run_lines_stream(spark, lines, transform, "stream_recs")) \
        .drop("batch_id")


# ---------------------------------------------------------------- approximate and fold-in
# (property checks; no SQL oracle)

@query("similar_tracks_lsh")
def q_similar_tracks_lsh(spark, sf_dir):
    from encore.operators.similar import similar_tracks_lsh
    sim = similar_tracks_lsh(td.vectors(spark, sf_dir), k=K)
    return sim.select("track_id", "rank", "similar_track_id", _dbl("similarity"),
                      "similar_label")


@query("filter_dismissed_bloom")
def q_filter_dismissed_bloom(spark, sf_dir):
    from encore.operators.bloom import filter_dismissed_bloom
    kept = filter_dismissed_bloom(_today_candidates(spark, sf_dir), td.dismissals(spark, sf_dir))
    return kept.select("user_id", "track_id", _dbl("score"))


@query("als_fold_in")
def q_als_fold_in(spark, sf_dir):
    """M4: item vectors re-solved from the recent history with user factors fixed."""
    from encore.operators.model import fold_in_items, train_implicit_als, user_factors
    rank = 8
    ratings = materialize(spark, training.history_training_ratings(spark, sf_dir),
                          "fold_in_ratings")
    users = materialize(spark, user_factors(train_implicit_als(ratings, rank=rank,
                                                               iterations=5)), "user_factors")
    gram = agg.gram_array(users, rank)
    events = td.history_daily(spark, sf_dir).select(
        F.col("user_id").cast("int").alias("user_id"), "track_id", "rating")
    vectors = fold_in_items(events, users, gram, rank)
    return training.item_factor_summary(vectors)


@query("stream_fold_in")
def q_stream_fold_in(spark, sf_dir):
    """M4 in the stream: each batch re-solves the vectors of the tracks it played,
    with user factors from an ALS on the accumulated ratings."""
    users, gram, rank = _acc_model(spark, sf_dir)
    lines = source.event_lines(_event_stream(spark, sf_dir))
    out = _run_lines_stream(spark, lines, recommender.fold_in_transform(users, gram, rank),
                            "stream_fold_in")
    return training.item_factor_summary(spark.read.parquet(out))


def _acc_model(spark, sf_dir):
    """User vectors, their Gram matrix and the rank of an ALS on the accumulated ratings."""
    from encore.operators.model import train_implicit_als, user_factors
    rank = 8
    ratings = materialize(spark, to_als_rating(td.acc(spark, sf_dir)), "acc_ratings")
    users = materialize(spark, user_factors(train_implicit_als(ratings, rank=rank,
                                                               iterations=5)), "acc_users")
    return users, agg.gram_array(users, rank), rank


@query("stream_carried_fold_in")
def q_stream_carried_fold_in(spark, sf_dir):
    """M4 in T6 with state: the lines come in three batches, vectors are carried from each to the next."""
    users, gram, rank = _acc_model(spark, sf_dir)
    folder, out = scratch_path(spark, "carried_log"), scratch_path(spark, "carried_out")
    checkpoint = scratch_path(spark, "carried_checkpoint")
    for part in range(3):
        mine = td.plays(spark, sf_dir).filter(F.col("event_id") % 3 == part)
        to_daily_lines(mine).write.mode("append").text(folder)
        with carried.state_on_disk(spark):
            process.run_stream(carried.folded_stream(line_log(spark, folder), users, gram, rank),
                               process.batch_dir_writer(out, lambda df, _id: df), checkpoint)
    return training.item_factor_summary(carried.latest_vectors(spark, out))


@query("similar_tracks_cells")
def q_similar_tracks_cells(spark, sf_dir):
    """The stored index, all of its cells probed: the exact lists."""
    vec = td.vectors(spark, sf_dir)
    index = cells.build_cells(vec, scratch_path(spark, "cells"))
    sim = index.nearest(vec, K, probes=len(index.centroids))
    return sim.select("track_id", "rank", "similar_track_id", _dbl("similarity"), "similar_label")


@query("similar_tracks_probed")
def q_similar_tracks_probed(spark, sf_dir):
    """A fifth of the stored index's cells probed (recall in tests/test_cells.py)."""
    vec = td.vectors(spark, sf_dir)
    sim = cells.build_cells(vec, scratch_path(spark, "cells")).nearest(vec, K)
    return sim.select("track_id", "rank", "similar_track_id", _dbl("similarity"), "similar_label")

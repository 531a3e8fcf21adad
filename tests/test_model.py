"""ALS properties and fold-in against a numpy closed form."""

import numpy as np

from tests.conftest import SF_SMALL
from encore.operators.aggregates import gram_matrix
from encore.operators.model import events_without_factor, fold_in_items, item_factors, train_implicit_als
from encore.plans.training import history_training_ratings


def test_fold_in_matches_numpy(spark):
    rng = np.random.default_rng(3)
    rank, alpha, reg = 3, 40.0, 0.01
    users = rng.normal(size=(6, rank))
    events = [(0, 10, 1.0), (1, 10, 2.0), (2, 10, 1.0), (3, 11, 4.0), (4, 11, 1.0),
              (5, 12, 1.0)]
    repeated = [(0, 10, 0.25), (0, 10, 0.75)] + events[1:] + [(9, 10, 5.0)]  # user 9 has no vector
    udf_ = spark.createDataFrame([(i, users[i].tolist()) for i in range(6)],
                                 "user_id int, features array<double>")
    edf = spark.createDataFrame(repeated, "user_id int, track_id long, rating double")
    gram = np.zeros((rank, rank))
    for r in gram_matrix(udf_.repartition(3), dim=rank).collect():
        gram[r.i, r.j] = r.value
    np.testing.assert_allclose(gram, users.T @ users, atol=1e-9)
    assert [r.user_id for r in events_without_factor(edf, udf_).collect()] == [9]
    got, dealt = ({r.track_id: np.array(r.features) for r in fold_in_items(
        edf.repartition(2), udf_, gram, rank, reg, alpha, pairs_per_task=pairs).collect()}
        for pairs in (100, 1))
    assert sorted(got) == sorted(dealt) == [10, 11, 12]
    for track in (10, 11, 12):
        rows = [(u, r) for u, t, r in events if t == track]
        a = users.T @ users
        b = np.zeros(rank)
        for u, r in rows:
            c = 1 + alpha * r
            a += (c - 1) * np.outer(users[u], users[u])
            b += c * users[u]
        a += reg * len(rows) * np.eye(rank)
        np.testing.assert_allclose(got[track], np.linalg.solve(a, b), rtol=1e-8)
        np.testing.assert_allclose(dealt[track], got[track], rtol=1e-8)


def test_als_factors_are_finite_and_one_per_track(spark):
    ratings = history_training_ratings(spark, SF_SMALL).cache()
    model = train_implicit_als(ratings, rank=4, iterations=3, blocks=2)
    f = item_factors(model).toPandas()
    n_tracks = ratings.select("track_id").distinct().count()
    assert len(f) == n_tracks == f.track_id.nunique()
    assert all(len(v) == 4 and np.isfinite(v).all() for v in f.features)
    again = item_factors(train_implicit_als(ratings, rank=4, iterations=3, blocks=2)).toPandas()
    a = np.stack(f.sort_values("track_id").features)
    b = np.stack(again.sort_values("track_id").features)
    np.testing.assert_allclose(a, b, atol=1e-4)


def test_stream_fold_in_equals_batch_fold_in(spark):
    from pyspark.sql import functions as F

    from encore.functions.parse import to_als_rating
    from encore.operators.model import user_factors
    from encore.operators.recommend import weigh_events
    from encore.session import scratch_path
    from encore.sources import testdata as td
    from encore.streaming import process, recommender, source
    rank = 4
    ratings = to_als_rating(td.acc(spark, SF_SMALL)).cache()
    users = user_factors(train_implicit_als(ratings, rank=rank, iterations=3, blocks=2)).cache()
    gram = np.zeros((rank, rank))
    for r in gram_matrix(users, dim=rank).collect():
        gram[r.i, r.j] = r.value
    schema = td.table(spark, SF_SMALL, "events").schema
    lines = source.event_lines(source.file_events(spark, f"{SF_SMALL}/event[s].parquet", schema))
    out = scratch_path(spark, "fold_stream")
    process.run_stream(lines, process.batch_dir_writer(
        out, recommender.fold_in_transform(users, gram, rank)), scratch_path(spark, "fold_ckpt"))
    streamed = {r.track_id: np.array(r.features) for r in spark.read.parquet(out).collect()}
    batch_ratings = (weigh_events(td.plays(spark, SF_SMALL)).groupBy("user_id", "track_id")
                     .agg(F.sum("weight").cast("double").alias("rating"))
                     .select(F.col("user_id").cast("int").alias("user_id"), "track_id", "rating"))
    batch = {r.track_id: np.array(r.features)
             for r in fold_in_items(batch_ratings, users, gram, rank).collect()}
    assert set(streamed) == set(batch) and len(batch) > 0
    for t in batch:
        np.testing.assert_allclose(streamed[t], batch[t], rtol=1e-9, atol=1e-12)


def test_stream_candidates_use_refreshed_vectors(spark):
    from pyspark.sql import functions as F

    from encore.functions.parse import parse_daily, to_als_rating
    from encore.operators.model import user_factors
    from encore.operators.recommend import weigh_events
    from encore.plans.batch import build_index
    from encore.sources import testdata as td
    from encore.sources.text import to_daily_lines
    from encore.streaming.recommender import Refresh, recommend_transform, refreshed_index
    rank = 4
    model = train_implicit_als(to_als_rating(td.acc(spark, SF_SMALL)), rank=rank, iterations=3,
                               blocks=2)
    users, vectors = user_factors(model).cache(), item_factors(model).cache()
    gram = np.zeros((rank, rank))
    for r in gram_matrix(users, dim=rank).collect():
        gram[r.i, r.j] = r.value
    index = build_index(vectors, k=5)
    refresh = Refresh(vectors, users, gram, rank, k=5)
    lines = to_daily_lines(td.plays(spark, SF_SMALL)).limit(40).cache()
    events = parse_daily(lines)
    fresh = {r.track_id: np.array(r.features) for r in fold_in_items(
        weigh_events(events).select("user_id", "track_id", F.col("weight").alias("rating")),
        users, gram, rank).collect()}
    stored = {r.track_id: np.array(r.features) for r in vectors.collect()}
    before = {t: [] for t in stored}
    for r in index.table.orderBy("track_id", "rank").collect():
        before[r.track_id].append(r.similar_track_id)
    after = {}
    for r in refreshed_index(index, events, refresh).table.collect():
        after.setdefault(r.track_id, {})[r.similar_track_id] = float(r.similarity)
    assert fresh
    for t, found in after.items():
        if t not in fresh:
            assert set(found) == set(before[t])
            continue
        cos = {o: fresh[t] @ v / np.linalg.norm(fresh[t]) / np.linalg.norm(v)
               for o, v in stored.items() if o != t}
        best = sorted(cos.values(), reverse=True)[:5]
        np.testing.assert_allclose(sorted(found.values(), reverse=True), best, atol=2e-6)
    no_dismissals = td.dismissals(spark, SF_SMALL).limit(0)
    plain = recommend_transform(index, no_dismissals, None)(lines, 3).collect()
    out = recommend_transform(index, no_dismissals, None, refresh=refresh)(lines, 3).collect()
    assert out and {r.batch_id for r in out} == {3} and sorted(out) != sorted(plain)

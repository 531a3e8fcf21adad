"""The three jobs on line files made from the test tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from encore import jobs, session
from encore.functions.parse import parse_ratings
from encore.functions.score import REASON_WEIGHTS
from encore.plans import batch
from encore.session import scratch_path
from encore.sinks.files import read_previous_recs, read_user_recs, write_table
from encore.sources import testdata as td
from encore.sources.text import scan_lines, to_daily_lines, to_rating_lines, write_lines
from tests.conftest import SF_MID, SF_SMALL
from tests.oracle_compare import duck, rows


@pytest.fixture(scope="module")
def inputs(spark):
    sf = SF_SMALL
    index = batch.build_index(td.vectors(spark, sf))
    return {
        "daily": write_lines(to_daily_lines(td.daily(spark, sf)), scratch_path(spark, "j_daily")),
        "vectors": write_table(td.vectors(spark, sf), scratch_path(spark, "j_vectors")),
        "dismissals": write_table(td.dismissals(spark, sf), scratch_path(spark, "j_dis")),
        "previous": write_table(batch.previous_recs(spark, sf, index),
                                scratch_path(spark, "j_prev")),
    }


def test_batch_job_equals_flagship_oracle(spark, inputs):
    out = jobs.run_batch(spark, inputs["daily"] + "/part-*", inputs["vectors"],
                         scratch_path(spark, "j_out"), inputs["dismissals"], inputs["previous"])
    got = read_user_recs(spark, out).toPandas()
    sql = ("SELECT user_id, rank, track_id, score FROM ("
           + entry.oracle_sql()["batch_recommendations"] + ") t")
    want = duck(SF_SMALL).execute(sql).df()
    assert list(want.columns) == ["user_id", "rank", "track_id", "score"]
    assert rows(got) == rows(want)


def test_stream_job_equals_batch_job(spark, inputs):
    out_b = jobs.run_batch(spark, inputs["daily"], inputs["vectors"],
                           scratch_path(spark, "j_out_b"), inputs["dismissals"],
                           inputs["previous"])
    out_s = scratch_path(spark, "j_out_s")
    jobs.run_stream(spark, inputs["vectors"], out_s, scratch_path(spark, "j_ckpt"),
                    jobs.text_line_stream(spark, inputs["daily"]), inputs["dismissals"],
                    inputs["previous"], available_now=True)
    got = spark.read.parquet(out_s).select("user_id", "rank", "track_id", "score").toPandas()
    want = read_user_recs(spark, out_b).toPandas()
    assert len(got) > 0 and rows(got) == rows(want)


def test_train_job(spark):
    sf = SF_MID
    acc = write_lines(to_rating_lines(td.acc(spark, sf)), scratch_path(spark, "j_acc"))
    daily = write_lines(to_daily_lines(td.daily(spark, sf)), scratch_path(spark, "j_day"))
    out = jobs.run_train(spark, acc, daily, scratch_path(spark, "j_train"), "2024-01-25",
                         rank=4, iterations=2, blocks=2)
    merged = parse_ratings(scan_lines(spark, out["accumulated"]))
    factors = spark.read.parquet(out["item_factors"])
    assert merged.count() > 0
    assert factors.count() == merged.select("track_id").distinct().count()
    assert factors.select(F.size("features").alias("d")).distinct().collect()[0].d == 4
    # the new accumulated lines parse back without loss
    assert parse_ratings(scan_lines(spark, out["accumulated"])).count() == \
        scan_lines(spark, out["accumulated"]).count()


def test_prebuilt_index_gives_the_same_recs(spark, inputs):
    index = jobs.run_index(spark, inputs["vectors"], scratch_path(spark, "j_index"))
    a = jobs.run_batch(spark, inputs["daily"], inputs["vectors"], scratch_path(spark, "j_a"),
                       inputs["dismissals"], inputs["previous"])
    b = jobs.run_batch(spark, inputs["daily"], inputs["vectors"], scratch_path(spark, "j_b"),
                       inputs["dismissals"], inputs["previous"], index=index)
    ra, rb = read_user_recs(spark, a).toPandas(), read_user_recs(spark, b).toPandas()
    assert len(ra) > 0 and rows(ra) == rows(rb)


def test_jobs_feed_each_other(spark, inputs):
    """Trainer -> index -> first day -> second day; a day that is not there yet; refused lines."""
    acc = write_lines(to_rating_lines(td.acc(spark, SF_MID)), scratch_path(spark, "c_acc"))
    daily = td.daily(spark, SF_MID)
    bad = spark.createDataFrame([("no,event",), ("1,2,1445047130,1.0,telepathy,null",)], "value string")
    day = write_lines(to_daily_lines(daily).unionByName(bad), scratch_path(spark, "c_day"))
    model = jobs.run_train(spark, acc, [day, day + "-tomorrow"], scratch_path(spark, "c_train"),
                           "2024-01-25", rank=4, iterations=2, blocks=2)
    factors = model["item_factors"]
    index = jobs.run_index(spark, factors, scratch_path(spark, "c_index"))
    first = jobs.run_batch(spark, day, factors, scratch_path(spark, "c_first"), index=index)
    counts = {r.parse_error: r.n for r in spark.read.parquet(first + "_refused/counts").collect()}
    unknown = daily.filter(~F.col("reason_start").isin(*REASON_WEIGHTS)).count()
    assert counts == {"expected 6 fields, found 2": 1, "unknown reason": unknown + 1}
    second = jobs.run_batch(spark, day, factors, scratch_path(spark, "c_second"), index=index,
                            previous=first)
    a, b = read_user_recs(spark, first).toPandas(), read_user_recs(spark, second).toPandas()
    # the same day again: the earlier list holds the same raw scores, so nothing changes
    assert len(a) > 0 and rows(a) == rows(b)
    raw = read_previous_recs(spark, first).toPandas()
    assert len(raw) == len(a) and (raw.score >= 0).any()


def test_a_job_plans_with_its_settings_and_leaves_its_outputs_alone(spark, inputs, monkeypatch):
    """The given number of partitions is in the plan; X5: scratch tables go with the job."""
    import os

    plans, made = [], []
    real_recommend, real_path = jobs.recommend, session.scratch_path

    def recommend(*args, **kwargs):
        out = real_recommend(*args, **kwargs)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        made.extend(session._SCOPES[-1])
        return out

    monkeypatch.setattr(jobs, "recommend", recommend)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = real_path(spark, "j_sized")
    jobs.main(["batch", "--daily", inputs["daily"], "--vectors", inputs["vectors"], "--out", out,
               "--previous", inputs["previous"], "--partitions", "13"])
    assert ", 13)" in plans[0] and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert not read_user_recs(spark, out).isEmpty()
    assert made and not any(os.path.exists(p.removeprefix("file:")) for p in made)
    assert session._SCOPES == []


def test_scale_settings_grow_with_the_shuffle(spark):
    assert session.scale_conf(10 ** 15, 100)["spark.sql.shuffle.partitions"] == str(-(-10 ** 15 // 2 ** 28))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    with session.sized(spark, shuffle_bytes=10 ** 12):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3726" and spark.conf.get(key) == str(2 ** 27)
    assert spark.conf.get(key, None) == before

"""Streaming behaviour: watermark drops late rows, empty batches are skipped,
a replayed batch overwrites its own output."""

import datetime as dt
import os

from pyspark.sql import functions as F

from encore.session import scratch_path
from encore.streaming import process, window


def _write_batch(spark, path, rows):
    df = spark.createDataFrame(rows, "ts timestamp_ntz, track_id long, weight double")
    df.coalesce(1).write.mode("append").parquet(path)


def test_watermark_drops_late_rows(spark):
    src, out = scratch_path(spark, "wm_src"), scratch_path(spark, "wm_out")
    ckpt = scratch_path(spark, "wm_ckpt")
    schema = "ts timestamp_ntz, track_id long, weight double"
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)

    def run():
        stream = spark.readStream.schema(schema).parquet(src)
        windows = window.track_windows(stream, "1 day", "1 hour")
        q = (windows.writeStream.outputMode("update")
             .foreachBatch(process.batch_dir_writer(out, lambda df, _id: df))
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()

    _write_batch(spark, src, [(day(10, 5), 1, 1.0), (day(10, 6), 1, 2.0)])
    run()
    # day 1 is far behind the watermark (day 10 05:00 - 1 hour): dropped;
    # day 10 07:00 is on time and updates the open window
    _write_batch(spark, src, [(day(1), 1, 100.0), (day(10, 7), 1, 4.0)])
    run()
    rows = spark.read.parquet(out)
    latest = (rows.groupBy("window_start", "track_id")
              .agg(F.max_by("weight_sum", "batch_id").alias("w"),
                   F.max_by("n_events", "batch_id").alias("n")).collect())
    got = {(r.window_start, r.track_id): (r.n, r.w) for r in latest}
    assert got == {(day(10), 1): (3, 7.0)}


def test_empty_batch_is_skipped_and_replay_overwrites(spark):
    out = scratch_path(spark, "writer")
    write = process.batch_dir_writer(out, lambda df, _id: df)
    empty = spark.createDataFrame([], "x long")
    write(empty, 0)
    assert not os.path.exists(out.replace("file:", "") + "/batch_id=0")
    write(spark.createDataFrame([(1,), (2,)], "x long"), 1)
    write(spark.createDataFrame([(3,)], "x long"), 1)  # replay of batch 1
    assert sorted(r.x for r in spark.read.parquet(out).collect()) == [3]


def test_processing_time_trigger_runs_and_stops(spark):
    from encore.functions.parse import parse_daily
    from encore.sources import testdata as td
    from encore.streaming import source
    from tests.conftest import SF_SMALL
    schema = td.table(spark, SF_SMALL, "events").schema
    lines = source.event_lines(source.file_events(spark, f"{SF_SMALL}/event[s].parquet", schema))
    out = scratch_path(spark, "ptime")
    q = process.run_stream(lines, process.batch_dir_writer(out, lambda df, _id: parse_daily(df)),
                           scratch_path(spark, "ptime_ckpt"), available_now=False,
                           processing_time="1 second", timeout=45)
    assert not q.isActive
    assert spark.read.parquet(out).count() == td.table(spark, SF_SMALL, "events").count()

"""The applications as Spark jobs over the line formats.

* ``index``: track vectors -> the similar-tracks table (K6), built once.
* ``batch``: daily event lines + track vectors (+ index, dismissals,
  previous recs) -> each user's final recommendations (K1).
* ``train``: accumulated rating lines + daily event lines -> the new
  accumulated rating lines (K4) and the ALS item factors (K3).
* ``cells``: track vectors -> a stored index that new vectors can probe (K6).
* ``fold-in``: daily event lines as a stream -> the vectors of their tracks,
  carried from batch to batch (M4).
* ``stream``: daily event lines from Kafka (or a directory of text files, or
  of line files that grow) -> per-batch recommendations (K2).

Run with spark-submit, e.g.

    spark-submit --py-files encore.zip encore/jobs.py batch \\
        --daily 'hdfs:///events/daily_*.txt' --vectors hdfs:///vectors \\
        --out hdfs:///recs/2024-01-25

Every output goes to a new directory; inputs are never overwritten. Lines
that a job can't use are written beside its output with the reason, and counted.
The jobs feed each other: ``index``, ``batch`` and ``stream`` take the trainer's
item factors as vectors, ``batch`` and ``stream`` an earlier batch output as
previous recs.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a script: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from encore.functions.parse import (DAILY_FIELDS, RATING_FIELDS, parse_daily_lines,  # noqa: E402
                                    parse_rating_lines, quarantine, to_als_rating)
from encore.operators.filters import filter_recent  # noqa: E402
from encore.operators.aggregates import as_array, gram_matrix  # noqa: E402
from encore.operators.cells import build_cells, load_cells  # noqa: E402
from encore.operators import model as als  # noqa: E402
from encore.operators.recommend import refused_events, weigh_events  # noqa: E402
from encore.plans.batch import (DEFAULT_K, DEFAULT_N, build_index, load_index,  # noqa: E402
                                recommend)
from encore.plans.training import merged_active_ratings  # noqa: E402
from encore.sinks import keyed  # noqa: E402
from encore.sinks.files import (materialize, read_previous_recs, write_rating_lines,  # noqa: E402
                                write_table, write_user_recs)
from encore.sources.line_log import line_log  # noqa: E402
from encore.sources.text import scan_lines  # noqa: E402
from encore.session import scratch_path, scratch_scope, ship_package, sized  # noqa: E402
from encore.streaming import carried, process, recommender, source  # noqa: E402

EMPTY_PAIRS = "user_id bigint, track_id bigint"


def _pairs_or_empty(spark: SparkSession, path: str | None) -> DataFrame:
    if path:
        return spark.read.parquet(path).select("user_id", "track_id")
    return spark.createDataFrame([], EMPTY_PAIRS)


def _index(spark: SparkSession, vectors: str, index: str | None, k: int):
    vec = spark.read.parquet(vectors)
    return load_index(spark, index, vec) if index else build_index(vec, k)


def _write_refused(spark: SparkSession, refused: DataFrame, path: str) -> None:
    """(line, parse_error) under ``<path>/lines`` and their number by reason under ``<path>/counts``."""
    lines = spark.read.parquet(write_table(refused, f"{path}/lines"))
    write_table(lines.groupBy("parse_error").agg(F.count(F.lit(1)).alias("n")), f"{path}/counts")


def _good(parsed: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    return parsed.filter(F.col("parse_error").isNull()).select(*fields)


def run_index(spark: SparkSession, vectors: str, out: str, k: int = DEFAULT_K) -> str:
    """K6: the similar-tracks table, written once and reused by batch and stream."""
    built = build_index(spark.read.parquet(vectors), k)
    return write_table(built.table, out)


def run_batch(spark: SparkSession, daily: str, vectors: str, out: str,
              dismissals: str | None = None, previous: str | None = None,
              n: int = DEFAULT_N, k: int = DEFAULT_K, index: str | None = None) -> str:
    """Batch recommender. ``vectors``: parquet (track_id, features, optional label);
    ``dismissals``: parquet (user_id, track_id); ``previous``: parquet
    (user_id, track_id, score) or an earlier output of this job; ``index``: a
    table from ``run_index``. Refused lines go to ``<out>_refused``."""
    parsed = parse_daily_lines(scan_lines(spark, daily))
    _write_refused(spark, refused_events(parsed), f"{out}_refused")
    index = _index(spark, vectors, index, k)
    prev = read_previous_recs(spark, previous) if previous else None
    recs = recommend(_good(parsed, DAILY_FIELDS), index, _pairs_or_empty(spark, dismissals),
                     prev, n)
    return write_user_recs(recs, out, n)


def run_train(spark: SparkSession, accumulated: str, daily: str, out: str, as_of: str,
              rank: int = 40, iterations: int = 15, blocks: int | None = None,
              alpha: float = 40.0, reg: float = 0.01) -> dict[str, str]:
    """Model trainer: writes ``<out>/accumulated`` (lines), ``<out>/item_factors``, ``<out>/user_factors``
    and their Gram matrix ``<out>/gram`` (for fold-ins), and refused lines under ``<out>/refused_ratings`` and ``<out>/refused_daily``.
    A daily path that is not there is skipped (S4)."""
    ratings = parse_rating_lines(scan_lines(spark, accumulated))
    _write_refused(spark, quarantine(ratings), f"{out}/refused_ratings")
    acc = materialize(spark, filter_recent(_good(ratings, RATING_FIELDS), as_of), "recent_ratings")
    events = parse_daily_lines(scan_lines(spark, daily, ignore_missing=True))
    _write_refused(spark, refused_events(events, doubles=True), f"{out}/refused_daily")
    day = (weigh_events(_good(events, DAILY_FIELDS), doubles=True)
           .select("user_id", "track_id", "ts", F.col("weight").alias("score")))
    merged = materialize(spark, merged_active_ratings(acc, day, as_of), "merged_ratings")
    lines = write_rating_lines(merged, f"{out}/accumulated")
    model = als.train_implicit_als(to_als_rating(merged), rank=rank, iterations=iterations,
                               reg=reg, alpha=alpha, blocks=blocks)
    factors = write_table(als.item_factors(model), f"{out}/item_factors")
    users = write_table(als.user_factors(model), f"{out}/user_factors")
    gram = write_table(gram_matrix(spark.read.parquet(users), rank).coalesce(1), f"{out}/gram")
    return {"accumulated": lines, "item_factors": factors, "user_factors": users, "gram": gram}


def run_cells(spark: SparkSession, vectors: str, out: str) -> str:
    """K6: the stored index of cells, which the stream probes with refreshed vectors."""
    return build_cells(spark.read.parquet(vectors), out).path


def _user_model(spark: SparkSession, user_factors: str, gram: str):
    """User factors, their Gram matrix and its rank, as the trainer wrote them."""
    table = spark.read.parquet(gram)
    rank = 1 + table.agg(F.max("i")).first()[0]
    return spark.read.parquet(user_factors), as_array(table, rank), rank


def run_fold_in(spark: SparkSession, user_factors: str, gram: str, out: str, checkpoint: str, lines: DataFrame,
                available_now: bool = False, processing_time: str = "10 seconds", timeout: float | None = None):
    """M4 in T6: item vectors carried from batch to batch, written to ``<out>/batch_id=<id>``."""
    users, matrix, rank = _user_model(spark, user_factors, gram)
    with carried.state_on_disk(spark):
        return process.run_stream(carried.folded_stream(lines, users, matrix, rank),
                                  process.batch_dir_writer(out, lambda df, _id: df), checkpoint,
                                  available_now=available_now, processing_time=processing_time, timeout=timeout)


def run_stream(spark: SparkSession, vectors: str, out: str, checkpoint: str,
               lines: DataFrame, dismissals: str | None = None,
               previous: str | None = None, n: int = DEFAULT_N, k: int = DEFAULT_K,
               available_now: bool = False, processing_time: str = "10 seconds",
               timeout: float | None = None, index: str | None = None,
               user_buckets: int | None = None, user_factors: str | None = None, gram: str | None = None,
               cells: str | None = None, folded: str | None = None):
    """Streaming recommender on a stream of daily-event lines (column ``value``).
    With ``user_factors`` and ``gram`` (the trainer's) candidates come from the batch's
    refreshed vectors: those that ``run_fold_in`` carries in ``folded``, or folded from
    the batch; ``cells`` (``run_cells``) are probed with them, else all vectors are searched.
    With ``user_buckets`` the dismissals and earlier recs are laid out by user
    first, and a batch reads its users' buckets alone.
    Refused lines go to ``<out>_refused/batch_id=<id>``."""
    index = _index(spark, vectors, index, k)
    prev = read_previous_recs(spark, previous) if previous else None
    dismissed = _pairs_or_empty(spark, dismissals)
    if user_buckets:
        dismissed = keyed.write_by_user(dismissed, scratch_path(spark, "dismissals"), user_buckets)
        prev = prev and keyed.write_by_user(prev, scratch_path(spark, "previous_recs"), user_buckets)
    refresh = None
    if user_factors:
        refresh = recommender.Refresh(spark.read.parquet(vectors), *_user_model(spark, user_factors, gram), k,
                                      load_cells(spark, cells) if cells else None, folded)
    recommended = recommender.recommend_transform(index, dismissed, prev, n, refresh)

    def transform(batch: DataFrame, batch_id: int) -> DataFrame:
        (refused_events(parse_daily_lines(batch)).write.mode("overwrite")
         .parquet(f"{out}_refused/batch_id={batch_id}"))
        return recommended(batch, batch_id)

    return process.run_stream(lines, process.batch_dir_writer(out, transform), checkpoint,
                              available_now=available_now, processing_time=processing_time,
                              timeout=timeout)


def text_line_stream(spark: SparkSession, directory: str) -> DataFrame:
    """New text files in ``directory`` as a stream of lines (a stand-in for Kafka)."""
    return spark.readStream.text(directory)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="encore.jobs")
    sub = parser.add_subparsers(dest="job", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--daily", required=True)
    b.add_argument("--vectors", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--dismissals")
    b.add_argument("--previous")
    b.add_argument("--n", type=int, default=DEFAULT_N)
    b.add_argument("--k", type=int, default=DEFAULT_K)
    b.add_argument("--index")
    x = sub.add_parser("index")
    x.add_argument("--vectors", required=True)
    x.add_argument("--out", required=True)
    x.add_argument("--k", type=int, default=DEFAULT_K)
    c = sub.add_parser("cells")
    c.add_argument("--vectors", required=True)
    c.add_argument("--out", required=True)
    t = sub.add_parser("train")
    t.add_argument("--accumulated", required=True)
    t.add_argument("--daily", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--as-of", required=True)
    t.add_argument("--rank", type=int, default=40)
    t.add_argument("--iterations", type=int, default=15)
    t.add_argument("--blocks", type=int)
    s = sub.add_parser("stream")
    s.add_argument("--vectors", required=True)
    s.add_argument("--dismissals")
    s.add_argument("--previous")
    s.add_argument("--n", type=int, default=DEFAULT_N)
    s.add_argument("--k", type=int, default=DEFAULT_K)
    s.add_argument("--index")
    s.add_argument("--user-buckets", type=int, help="lay out dismissals and earlier recs by user in so many buckets")
    s.add_argument("--user-factors", help="the trainer's: candidates from vectors refreshed by each batch")
    s.add_argument("--gram", help="the trainer's, with --user-factors")
    s.add_argument("--cells", help="output of the job cells, probed with refreshed vectors")
    s.add_argument("--folded", help="output of the job fold-in, whose vectors go before those of the batch alone")
    f = sub.add_parser("fold-in")
    f.add_argument("--user-factors", required=True)
    f.add_argument("--gram", required=True)
    for job in (s, f):
        job.add_argument("--out", required=True)
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--kafka-servers")
        job.add_argument("--topic")
        job.add_argument("--lines-dir", help="read new text files here instead of Kafka")
        job.add_argument("--log-dir", help="read line files that grow here, by offset, instead of Kafka")
        job.add_argument("--max-bytes", type=int, help="bytes of one micro-batch from --log-dir at most")
        job.add_argument("--max-offsets", type=int, help="Kafka messages of one micro-batch at most")
        job.add_argument("--min-partitions", type=int, help="split large topic partitions")
        job.add_argument("--trigger", default="10 seconds")
    for job in (b, x, c, t, s, f):
        job.add_argument("--partitions", type=int, help="shuffle partitions of this job (X4)")
        job.add_argument("--shuffle-bytes", type=int, help="size of its largest shuffle: sizes partitions and scans")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"encore-{args.job}").getOrCreate()
    ship_package(spark)
    with sized(spark, args.shuffle_bytes, args.partitions), scratch_scope(spark):
        _run(spark, args)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "batch":
        run_batch(spark, args.daily, args.vectors, args.out, args.dismissals, args.previous,
                  args.n, args.k, index=args.index)
    elif args.job == "index":
        run_index(spark, args.vectors, args.out, args.k)
    elif args.job == "cells":
        run_cells(spark, args.vectors, args.out)
    elif args.job == "train":
        run_train(spark, args.accumulated, args.daily, args.out, args.as_of, args.rank,
                  args.iterations, args.blocks)
    else:
        if args.lines_dir:
            lines = text_line_stream(spark, args.lines_dir)
        elif args.log_dir:
            lines = line_log(spark, args.log_dir, args.max_bytes, f"{args.checkpoint}_progress")
        else:
            lines = source.kafka_lines(spark, args.kafka_servers, args.topic,
                                       max_offsets_per_trigger=args.max_offsets,
                                       min_partitions=args.min_partitions)
        if args.job == "fold-in":
            run_fold_in(spark, args.user_factors, args.gram, args.out, args.checkpoint, lines,
                        processing_time=args.trigger)
            return
        run_stream(spark, args.vectors, args.out, args.checkpoint, lines, args.dismissals,
                   args.previous, args.n, args.k, processing_time=args.trigger,
                   index=args.index, user_buckets=args.user_buckets, user_factors=args.user_factors,
                   gram=args.gram, cells=args.cells, folded=args.folded)


if __name__ == "__main__":
    sys.exit(main())

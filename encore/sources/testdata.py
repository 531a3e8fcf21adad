"""Views of the supplied test tables in the engine's data model.

``plays`` maps the generic ``events`` table onto daily play events; the
other views (``daily``, ``acc``, ``history`` and its split, ``vectors``,
``dismissals``) follow from it. All of them are lazy DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators.recommend import weigh_events

# Fixed values of the test mapping: event type -> start reason.
EVENT_REASONS = {
    "purchase": "query",
    "click": "rec",
    "view": "browsing",
    "signup": "radio",
}
UNKNOWN_REASON = "unknown"
DISMISS_EVENT = "error"

# Fixed split points of the test tables.
DAILY_CUTOFF = "2024-01-25 00:00:00"
HISTORY_SPLIT = "2001-08-01 00:00:00"
HISTORY_AS_OF = "2001-11-04"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


def reason_of(event_type):
    expr = None
    for etype, reason in EVENT_REASONS.items():
        cond = event_type == F.lit(etype)
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr.otherwise(F.lit(UNKNOWN_REASON))


def plays_from_events(events: DataFrame) -> DataFrame:
    """Daily-event columns from ``events`` (works on batch and streaming frames)."""
    return events.select(
        "event_id", "user_id",
        F.get_json_object("props", "$.k").try_cast("int").cast("bigint").alias("track_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("value").cast("decimal(18,2)").alias("ms_played"),
        reason_of(F.col("event_type")).alias("reason_start"),
        F.lit(None).cast("string").alias("reason_end"))


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plays_from_events(table(spark, sf_dir, "events"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plays(spark, sf_dir).filter(F.col("ts") >= _ts(DAILY_CUTOFF))


def plays_before(spark: SparkSession, sf_dir: str, cutoff: str = DAILY_CUTOFF) -> DataFrame:
    return plays(spark, sf_dir).filter(F.col("ts") < _ts(cutoff))


def acc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accumulated ratings: earlier plays weighted and summed per (user, track)."""
    w = weigh_events(plays_before(spark, sf_dir))
    return (w.groupBy("user_id", "track_id")
            .agg(F.max("ts").alias("ts"), F.sum("weight").cast("double").alias("rating")))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long rating history: customer x part from lineitem joined with orders."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate",
                                                 "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("track_id"),
                    F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
                    F.col("l_quantity").cast("double").alias("rating")))


def history_acc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(spark, sf_dir).filter(F.col("ts") < _ts(HISTORY_SPLIT))


def history_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(spark, sf_dir).filter(F.col("ts") >= _ts(HISTORY_SPLIT))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track vectors: (track_id, features ARRAY<DOUBLE>, label)."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("track_id"),
        F.col("embedding").cast("array<double>").alias("features"), "label")


def dismissals_from_events(events: DataFrame, before: str | None = None) -> DataFrame:
    """Distinct dismissed (user, track) pairs; with ``before``, those first
    dismissed before that time. Both forms share one aggregate (the filter is
    on its result), so a plan using both scans the events once."""
    firsts = (events.filter(F.col("event_type") == F.lit(DISMISS_EVENT))
              .select("user_id",
                      F.get_json_object("props", "$.k").try_cast("int").cast("bigint")
                      .alias("track_id"), "ts")
              .filter(F.col("track_id").isNotNull())
              .groupBy("user_id", "track_id").agg(F.min("ts").alias("first_ts")))
    if before is not None:
        firsts = firsts.filter(F.col("first_ts") < _ts(before))
    return firsts.select("user_id", "track_id")


def dismissals(spark: SparkSession, sf_dir: str, before: str | None = None) -> DataFrame:
    """Distinct (user, track) pairs the user dismissed (``error`` events)."""
    return dismissals_from_events(table(spark, sf_dir, "events"), before)

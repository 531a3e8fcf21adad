"""Event-time windows (T5): the reproducible form of per-interval grouping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.time import instant_to_ntz, ntz_to_instant


def track_windows(plays: DataFrame, width: str = "1 day", watermark: str = "1 hour",
                  weight: str = "weight") -> DataFrame:
    """Tumbling event-time windows per track with a watermark for late data.

    Output: (window_start TIMESTAMP_NTZ, track_id, n_events, weight_sum).
    """
    timed = plays.withColumn("event_time", ntz_to_instant(F.col("ts")))
    return (timed.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", width), "track_id")
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum(weight).alias("weight_sum"))
            .select(instant_to_ntz(F.col("window.start")).alias("window_start"), "track_id",
                    "n_events", "weight_sum"))

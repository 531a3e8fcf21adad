"""Stream sources.

In production the events arrive as ``user,track,epoch,ms,reason,next`` lines
in the value of Kafka messages (the key is ignored). Tests use a parquet file
source; ``event_lines`` turns those rows into the same lines so both paths run
the same parser.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.sources.testdata import plays_from_events
from encore.sources.text import to_daily_lines


def kafka_lines(spark: SparkSession, bootstrap_servers: str, topics: str | list[str],
                starting_offsets: str = "latest",
                max_offsets_per_trigger: int | None = None,
                min_partitions: int | None = None, **options: str) -> DataFrame:
    """One Kafka source for all partitions of the topic(s); ``value`` as STRING.

    ``max_offsets_per_trigger`` bounds a micro-batch after a backlog (a restart
    after downtime reads in steps instead of one huge batch);
    ``min_partitions`` splits large topic partitions over more tasks.
    """
    topic_list = topics if isinstance(topics, str) else ",".join(topics)
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic_list)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def file_events(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None
                ) -> DataFrame:
    """Parquet file stream (the stand-in for the message bus in tests)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def event_lines(events: DataFrame) -> DataFrame:
    """Raw ``events`` rows -> daily-event lines (what a producer would publish)."""
    return to_daily_lines(plays_from_events(events))


def union_streams(*streams: DataFrame) -> DataFrame:
    """Several topics/sources as one stream."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out

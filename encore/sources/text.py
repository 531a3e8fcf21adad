"""Text line sources and writers.

``spark.read.text`` splits files by size; the reference needs one file per
partition only because it does not group by key, which we always do.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions.parse import NULL_TOKEN
from encore.functions.time import epoch_seconds


def _is_there(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)  # lists the path; nothing is read
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def scan_lines(spark: SparkSession, path: str | list[str],
               ignore_missing: bool = False) -> DataFrame:
    """One row per line, column ``value``; ``path`` may be a glob.

    ``ignore_missing=True`` (S4) skips paths and globs that match no file, and
    files that vanish between listing and reading; with none left the result
    is empty.
    """
    if not ignore_missing:
        return spark.read.text(path)
    found = [p for p in ([path] if isinstance(path, str) else path) if _is_there(spark, p)]
    if not found:
        return spark.createDataFrame([], "value string")
    return spark.read.option("ignoreMissingFiles", "true").text(found)


def _line(*fields: Column) -> Column:
    """Fields joined by commas; a NULL is an empty field, never one field fewer."""
    return F.concat_ws(",", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields])


def daily_line(df: DataFrame) -> Column:
    """Format a daily event as ``user,track,epoch_seconds,ms_played,reason_start,reason_end``."""
    return _line(F.col("user_id"), F.col("track_id"), epoch_seconds(F.col("ts")),
                 F.col("ms_played"), F.col("reason_start"),
                 F.coalesce(F.col("reason_end"), F.lit(NULL_TOKEN)))


def rating_line(df: DataFrame) -> Column:
    """Format a rating as ``user,track,epoch_seconds,rating``.

    A rating that 6 decimals hold is written with them, any other as the
    shortest text that reads back as the same double: no bit is lost.
    """
    rating = F.col("rating").cast("double")
    short = rating.try_cast("decimal(38,6)")
    text = F.when(short.cast("double") == rating, short.cast("string")).otherwise(rating.cast("string"))
    return _line(F.col("user_id"), F.col("track_id"), epoch_seconds(F.col("ts")), text)


def to_daily_lines(df: DataFrame) -> DataFrame:
    return df.select(daily_line(df).alias("value"))


def to_rating_lines(df: DataFrame) -> DataFrame:
    return df.select(rating_line(df).alias("value"))


def write_lines(lines: DataFrame, path: str) -> str:
    """Write a ``value`` column as text files into a new directory; returns ``path``."""
    lines.select("value").write.mode("errorifexists").text(path)
    return path

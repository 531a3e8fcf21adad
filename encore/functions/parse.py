"""Parsers for the comma-separated event and rating lines.

Lines have no header and no quoting. Splitting keeps trailing empty fields
(limit -1), so ``a,b,c,d,e,`` has six fields with an empty last one. Bad
numbers never fail the job: ``try_cast`` yields NULL and the row gets a
``parse_error`` that routes it to the quarantine output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.time import from_epoch_seconds

DAILY_FIELDS = ("user_id", "track_id", "ts", "ms_played", "reason_start", "reason_end")
RATING_FIELDS = ("user_id", "track_id", "ts", "rating")

# Fixed value: the generator writes the string null for a missing next event.
NULL_TOKEN = "null"


def split_line(line: Column) -> Column:
    return F.split(line, ",", -1)


def _first_error(checks: list[tuple[Column, str]]) -> Column:
    expr = None
    for bad, label in checks:
        expr = F.when(bad, F.lit(label)) if expr is None else expr.when(bad, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def _not_finite(number: Column) -> Column:
    """NULL, NaN or infinite: none is a play time or a rating."""
    return number.isNull() | F.isnan(number) | (F.abs(number) == float("inf"))


def parse_daily_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Every line with typed daily-event columns and ``parse_error`` (NULL if good)."""
    parts = split_line(F.col(value))
    out = lines.select(
        F.col(value).alias("line"),
        F.size(parts).alias("_n"),
        F.get(parts, F.lit(0)).try_cast("bigint").alias("user_id"),
        F.get(parts, F.lit(1)).try_cast("bigint").alias("track_id"),
        from_epoch_seconds(F.get(parts, F.lit(2)).try_cast("bigint")).alias("ts"),
        F.get(parts, F.lit(3)).try_cast("double").alias("ms_played"),
        F.get(parts, F.lit(4)).alias("reason_start"),
        F.nullif(F.get(parts, F.lit(5)), F.lit(NULL_TOKEN)).alias("reason_end"),
    )
    error = F.when(F.col("_n") != 6, F.concat(F.lit("expected 6 fields, found "),
                                              F.col("_n").cast("string"))).otherwise(
        _first_error([
            (F.col("user_id").isNull(), "bad user_id"),
            (F.col("track_id").isNull(), "bad track_id"),
            (F.col("ts").isNull(), "bad timestamp"),
            (_not_finite(F.col("ms_played")), "bad ms_played"),
        ]))
    return out.withColumn("parse_error", error).drop("_n")


def parse_rating_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Every line with typed accumulated-rating columns and ``parse_error``."""
    parts = split_line(F.col(value))
    out = lines.select(
        F.col(value).alias("line"),
        F.size(parts).alias("_n"),
        F.get(parts, F.lit(0)).try_cast("bigint").alias("user_id"),
        F.get(parts, F.lit(1)).try_cast("bigint").alias("track_id"),
        from_epoch_seconds(F.get(parts, F.lit(2)).try_cast("bigint")).alias("ts"),
        F.get(parts, F.lit(3)).try_cast("double").alias("rating"),
    )
    error = F.when(F.col("_n") != 4, F.concat(F.lit("expected 4 fields, found "),
                                              F.col("_n").cast("string"))).otherwise(
        _first_error([
            (F.col("user_id").isNull(), "bad user_id"),
            (F.col("track_id").isNull(), "bad track_id"),
            (F.col("ts").isNull(), "bad timestamp"),
            (_not_finite(F.col("rating")), "bad rating"),
        ]))
    return out.withColumn("parse_error", error).drop("_n")


def _good(parsed: DataFrame, fields: tuple[str, ...], mode: str) -> DataFrame:
    if mode == "failfast":
        checked = parsed.withColumn(
            "_check", F.when(F.col("parse_error").isNotNull(),
                             F.raise_error(F.concat(F.lit("malformed line: "), F.col("line")))))
        return checked.filter(F.col("_check").isNull()).select(*fields)
    if mode != "drop":
        raise ValueError(f"mode must be 'drop' or 'failfast', not {mode!r}")
    return parsed.filter(F.col("parse_error").isNull()).select(*fields)


def parse_daily(lines: DataFrame, value: str = "value", mode: str = "drop") -> DataFrame:
    """Good daily events only. ``mode='failfast'`` raises on the first bad line."""
    return _good(parse_daily_lines(lines, value), DAILY_FIELDS, mode)


def parse_ratings(lines: DataFrame, value: str = "value", mode: str = "drop") -> DataFrame:
    """Good accumulated ratings only."""
    return _good(parse_rating_lines(lines, value), RATING_FIELDS, mode)


def quarantine(parsed: DataFrame) -> DataFrame:
    """The bad lines and why, from ``parse_*_lines`` output."""
    return parsed.filter(F.col("parse_error").isNotNull()).select("line", "parse_error")


INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1


def _als_id(name: str) -> Column:
    outside = F.concat(F.lit(f"{name} outside INT: "), F.col(name).cast("string"))
    return (F.when(F.col(name).between(INT_MIN, INT_MAX), F.col(name).cast("int"))
            .otherwise(F.raise_error(outside).cast("int")).alias(name))


def to_als_rating(ratings: DataFrame, rating: str = "rating",
                  out_of_range: str = "fail") -> DataFrame:
    """P5 + F4: (user, track) as INT, non-null, with the rating.

    ALS takes INT ids only. An id outside that range fails the job;
    ``out_of_range='drop'`` leaves such rows out at the caller's own wish.
    """
    known = ratings.filter(F.col("user_id").isNotNull() & F.col("track_id").isNotNull()
                           & F.col(rating).isNotNull())
    if out_of_range == "drop":
        known = known.filter(F.col("user_id").between(INT_MIN, INT_MAX)
                             & F.col("track_id").between(INT_MIN, INT_MAX))
    elif out_of_range != "fail":
        raise ValueError(f"out_of_range must be 'fail' or 'drop', not {out_of_range!r}")
    return known.select(_als_id("user_id"), _als_id("track_id"),
                        F.col(rating).cast("double").alias("rating"))

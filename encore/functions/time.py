"""Time helpers that do not depend on the session time zone.

Parquet test tables load as TIMESTAMP_NTZ. Epoch conversions are written as
arithmetic on TIMESTAMP_NTZ so results are the same under any
``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Epoch seconds of the first moment of year 1 and the last second of year 9999.
EPOCH_RANGE = (-62135596800, 253402300799)


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ (floor for times after 1970)."""
    return F.timestamp_diff("SECOND", _epoch(), ts)


def from_epoch_seconds(seconds: Column) -> Column:
    """TIMESTAMP_NTZ from epoch seconds; NULL outside the years 1 to 9999, never an overflow."""
    return F.when(seconds.between(*EPOCH_RANGE), F.timestamp_add("SECOND", seconds, _epoch()))


def ntz_to_instant(ts: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC wall clock -> TIMESTAMP (needed by watermarks)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), ts))


def instant_to_ntz(ts: Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ as UTC wall clock."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), _epoch())

"""Lists per key in parts.

The reference joins a user's rating list with the user's event list, and
concatenates the events of a track. A hot key's list would not fit a task, so a
key's rows are dealt to as many parts as its number of rows asks for, and a
list belongs to (key, part). Exploding the lists of all parts gives back all rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that one part of a key has on average, at most.
PART_ROWS = 10_000


def co_listed(key: str, sides: dict[str, DataFrame], needs: str | None = None,
              part_rows: int = PART_ROWS) -> DataFrame:
    """(key, part, n_parts, one sorted list of structs for each side).

    The sides are united and grouped together, so their lists meet in one
    shuffle. A struct has the side's columns and ``times``, how often the row
    was stated: equal rows are one element, summed up before the shuffle, so a
    row repeated without end makes no long part. Other rows are dealt to parts
    by their hash. ``needs`` names a side without which a key is left out. A
    side without rows for a part has an empty list there; a null key is a key
    of its own.
    """
    kinds = {name: F.struct(*[c for c in df.columns if c != key]) for name, df in sides.items()}
    types = {name: df.select(kinds[name].alias("s")).schema["s"].dataType for name, df in sides.items()}
    each = [df.select(key, *[(kinds[n] if n == name else F.lit(None)).cast(types[n]).alias(n) for n in sides])
            for name, df in sides.items()]
    names = list(sides)
    rows = reduce(DataFrame.unionByName, each).groupBy(key, *names).agg(F.count(F.lit(1)).alias("_times"))
    there = F.max(F.col(needs).isNotNull()) if needs else F.lit(True)
    totals = rows.groupBy(F.col(key).alias("_key")).agg(
        F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("n_parts"), there.alias("_there"))
    dealt = rows.join(totals.filter("_there"), rows[key].eqNullSafe(totals["_key"])).withColumn(
        "part", F.pmod(F.xxhash64(*names), F.col("n_parts")).cast("int"))
    lists = [F.sort_array(F.collect_list(F.when(
        F.col(n).isNotNull(), F.struct(*[F.col(f"{n}.`{c}`").alias(c) for c in types[n].names],
                                       F.col("_times").alias("times"))))).alias(n) for n in names]
    return dealt.groupBy(key, "part", "n_parts").agg(*lists)


def user_lists(ratings: DataFrame, events: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Each rating user's ratings and daily events, (user_id, part, n_parts, ratings, events)."""
    return co_listed("user_id", {"ratings": ratings.select("user_id", "track_id", "ts", "rating"),
                                 "events": events.select("user_id", "track_id", "ts", "weight")},
                     "ratings", part_rows)


def track_event_lists(events: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """A1: the events of each track, (track_id, part, n_parts, events)."""
    return co_listed("track_id", {"events": events.select("track_id", "user_id", "ts", "weight")},
                     part_rows=part_rows)

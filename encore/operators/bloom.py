"""Per-user Bloom filter of dismissed tracks.

The filter may drop a few extra candidates (false positives, bounded by
``fp_rate``) but never keeps a dismissed one. A user's dismissals make one
filter of 64-bit words, joined once to the user's candidates; all bits of a
candidate are tested in that row, JVM-side. A user with more than
``PART_ITEMS`` dismissals has several filters, dealt by track, so no row grows
with the data and a user with a third of all dismissals spreads over many.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.operators.joins import reshuffled

LN2 = math.log(2.0)
WORD_BITS = 64
#: Dismissals of one filter, about; at a rate of 0.01 it takes some 5 KB.
PART_ITEMS = 4096


def _with_part(df: DataFrame, hot: DataFrame) -> DataFrame:
    """Each row's filter number: 0, or by track for a user with several filters."""
    part = F.pmod(F.xxhash64("track_id"), F.coalesce("_parts", F.lit(1)))
    return (df.join(hot, F.col("user_id").cast("bigint") == F.col("_hot"), "left")
            .withColumn("_part", part).drop("_hot", "_parts"))


def _bit_position(salt: Column) -> Column:
    return F.pmod(F.xxhash64("user_id", "track_id", salt), F.size("_words") * WORD_BITS)


def hot_users(dismissals: DataFrame, part_items: int = PART_ITEMS) -> DataFrame:
    """(user, number of filters) of the users whose dismissals don't fit one."""
    return (dismissals.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > part_items)
            .select(reshuffled("user_id").alias("_hot"),
                    F.ceil(F.col("n") / part_items).alias("_parts")))


def build_bloom(dismissals: DataFrame, hot: DataFrame, fp_rate: float = 0.01) -> DataFrame:
    """(user_id, _part, n_hashes, _words ARRAY<BIGINT>): one row per filter."""
    bits_per_item = -math.log(fp_rate) / (LN2 * LN2)
    items = _with_part(dismissals.select("user_id", "track_id"), hot)
    key = ["user_id", "_part"]
    sizes = (items.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("n_words", F.ceil(F.col("n") * bits_per_item / WORD_BITS).cast("int"))
             .select(*key, "n_words", F.greatest(F.lit(1), F.round(
                 F.col("n_words") * WORD_BITS / F.col("n") * LN2)).cast("int").alias("n_hashes")))
    # a filter of few items would take dozens of hashes; 16 are past any rate in use
    sizes = sizes.withColumn("n_hashes", F.least("n_hashes", F.lit(16)))
    hashed = (items.join(sizes, key)
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("n_hashes") - 1)))
              .withColumn("pos", F.pmod(F.xxhash64("user_id", "track_id", "salt"),
                                        F.col("n_words") * WORD_BITS)))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"),
                          (F.col("pos") % WORD_BITS).cast("int"))
    set_bits = hashed.select(*key, "n_hashes", F.expr(f"int(pos div {WORD_BITS})").alias("word"),
                             one.alias("bits"))
    every_word = sizes.select(*key, "n_hashes",
                              F.explode(F.sequence(F.lit(0), F.col("n_words") - 1)).alias("word"),
                              F.lit(0).cast("bigint").alias("bits"))
    words = (set_bits.unionByName(every_word).groupBy(*key, "n_hashes", "word")
             .agg(F.bit_or("bits").alias("bits")))
    # bounded: the words of one filter
    return (words.groupBy(*key, "n_hashes")
            .agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("w"))
            .select(*key, "n_hashes", F.col("w.bits").alias("_words")))


def probe_bloom(candidates: DataFrame, hot: DataFrame, filters: DataFrame) -> DataFrame:
    """Candidates with ``maybe_dismissed`` (True if all bits of the pair are set)."""
    def is_set(salt: Column) -> Column:
        pos = _bit_position(salt)
        word = F.get("_words", F.floor(pos / WORD_BITS).cast("int"))
        return F.getbit(word, (pos % WORD_BITS).cast("int")) == 1

    all_set = F.forall(F.sequence(F.lit(0), F.col("n_hashes") - 1), is_set)
    return (_with_part(candidates, hot).join(filters, ["user_id", "_part"], "left")
            .withColumn("maybe_dismissed", F.coalesce(all_set, F.lit(False)))
            .drop("_part", "n_hashes", "_words"))


def filter_dismissed_bloom(candidates: DataFrame, dismissals: DataFrame, fp_rate: float = 0.01,
                           part_items: int = PART_ITEMS) -> DataFrame:
    """drop candidates the user's Bloom filter reports as dismissed."""
    hot = hot_users(dismissals, part_items)
    filters = build_bloom(dismissals, hot, fp_rate)
    return (probe_bloom(candidates, hot, filters)
            .filter(~F.col("maybe_dismissed")).drop("maybe_dismissed"))

"""Shards with the corpus's mixture by proportional stratified interleaving (operator 7).

Law ``rows``: shard sizes in rows differ by one at most. Rows of a source are
ranked by a seeded digest of doc_id and text; a row's fractional rank is a point,
by its digest, of its part of 0 to 1, which a source's rows share equally. Sorted
by it, the sources interleave in proportion, and cutting the order into equal
parts gives shards that all match the mixture. Sources of one row spread as well.

No rank is taken over a whole source or table in one task: digests and
fractions are cut into ``STRATA`` fixed ranges, rows are ranked within a range,
and running sums of the ranges' counts are added.

Defined cases: a null source is a source of its own; a null text has no
bytes and crc 0; rows that repeat a doc_id and text are ranked one after the
other in either order; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

SHARDS, SEED, STRATA = 40, "mix-1", 4096


def ranked(rows: DataFrame, group: list[str], stratum: str, order: list[str], out: str) -> DataFrame:
    """Adds ``out``: the 0-based rank by (stratum, order) within ``group``, and ``out``_n: the group's size."""
    counts = rows.groupBy(*group, stratum).agg(F.count("*").alias("_n"))
    sums = W.partitionBy(*group)
    before = sums.orderBy(stratum).rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(*[F.col(c).alias(f"_{c}") for c in (*group, stratum)],
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                           F.sum("_n").over(sums).alias(f"{out}_n"))
    within = F.row_number().over(W.partitionBy(*group, stratum).orderBy(*order))
    met = rows.withColumn("_within", within).join(
        counts, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*group, stratum)])
    return met.withColumn(out, F.col("_before") + F.col("_within") - 1).drop(
        "_within", "_before", *[f"_{c}" for c in (*group, stratum)])


def stratum_of(digest: Column) -> Column:
    """One of ``STRATA`` ranges from the first three hex digits."""
    return F.conv(F.substring(digest, 1, 3), 16, 10).cast("int")


def sharded(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless in its shard), grown_shard (null for this law)."""
    utf8 = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    crc = F.crc32(utf8)
    named = F.concat_ws(":", F.lit(seed), key, crc.cast("string"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("source"), F.lit("")).alias("source"),
                       F.col("source").isNull().alias("no_source"),
                       (F.octet_length(utf8) + 16).cast("long").alias("size"), crc.alias("text_crc32"),
                       F.md5(named.cast("binary")).alias("digest"))
    rows = rows.withColumn("stratum", stratum_of(F.col("digest")))
    order = ["digest", "doc_id", "size", "text_crc32"]
    rows = ranked(rows, ["source", "no_source"], "stratum", order, "place").drop("stratum")
    # The digest's first digits follow from the place, so the point in the row's part comes from its last ones.
    point = F.conv(F.substring("digest", 25, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    rows = rows.withColumn("fraction", (F.col("place") + point) / F.col("place_n"))
    rows = rows.withColumns({"stratum": F.least(F.floor(F.col("fraction") * STRATA).cast("int"), F.lit(STRATA - 1)), "everything": F.lit(1)})
    rows = ranked(rows, ["everything"], "stratum", ["fraction", *order, "source", "no_source"], "global")
    # Shard s takes the places from ceil(s * n / shards) on.
    shard = F.expr(f"global * {shards} div global_n").cast("int")
    begin = F.expr(f"(shard * global_n + {shards - 1}) div {shards}")
    return rows.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("global") - begin).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

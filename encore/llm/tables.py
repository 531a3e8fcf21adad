"""Spark helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from encore.session import scratch_path, ship_package

#: Stands for a null key inside joins; a real id of this value is not supported.
NULL_ID = -(2 ** 63)


#: Rows of an Arrow batch: whole texts are long, so fewer than Spark's default.
BATCH_ROWS = 1000


def release() -> None:
    """Give freed memory back to the system: workers are kept from task to task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(work: Callable) -> Callable:
    """``work`` on Arrow batches, followed by ``release`` when a task ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            release()

    return run


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: what follows survives the loss of any executor, and
    nothing before is computed twice.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def opaque(col: Column) -> Column:
    """The same long value as an expression the planner can't see through.

    An aggregate feeding a join on its own key keeps its partitioning, and
    AQE does not split a join whose side is not a plain shuffle. Joining on
    ``opaque(key)`` puts a shuffle under both sides, so hot keys split.
    """
    return F.bitwise_not(F.bitwise_not(col.cast("long")))


#: Words of a map of keys: 4 MB to broadcast at most, and bits for many times as many keys as words.
SIFT_WORDS = 1 << 18


def sifted(rows: DataFrame, key: list[Column], wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` may be among those of ``wanted`` (its columns, not null): what a join by it needs to move.

    Each key of ``wanted`` marks one bit of a map of bounded size that is
    broadcast. A row whose bit another key has marked passes too, and none
    whose key is wanted is lost; the join that follows is the exact one.
    """

    def place(*columns):
        spot = F.xxhash64(*columns)
        return F.pmod(spot, F.lit(SIFT_WORDS)), F.pmod(F.shiftrightunsigned(spot, 32), F.lit(64)).cast("int")

    word, bit = place(*(F.col(c) for c in wanted.columns))
    marks = wanted.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_bits"))
    marks = marks.groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))  # SIFT_WORDS rows at most
    word, bit = place(*key)
    return rows.join(F.broadcast(marks), (word == F.col("_word")) & (F.getbit(F.col("_bits"), bit) == 1), "left_semi")


def text_key(salt: int | None) -> Column:
    """64 bits of the text under a salt; 0 where doc_ids alone tell rows apart (no salt)."""
    if salt is None:
        return F.lit(0).cast("long")
    return F.xxhash64(F.lit(salt), F.coalesce(F.col("text"), F.lit("")))


@dataclass(frozen=True)
class Identity:
    """How rows are named: by ``id_key`` and ``text_key(salt)``; ``again`` has the names of several rows.

    ``again`` (doc_id, th, n_bytes) is None where all ids differ. A name stands for one text.
    """

    salt: int | None
    again: DataFrame | None


def identity(docs: DataFrame) -> Identity:
    """Names under which no two texts are one: ids alone where they differ, else with 64 bits of the text.

    Names that several rows have are checked by another 64 bits of their texts;
    should two texts share a name, another salt is taken.
    """
    if docs.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return Identity(None, None)
    proof = F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.lit("proof"))
    for salt in itertools.count():
        named = docs.select(id_key().alias("doc_id"), text_key(salt).alias("th"), proof.alias("proof"),
                            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
        again = stored(named.groupBy("doc_id", "th").agg(
            F.count(F.lit(1)).alias("n"), F.min("proof").alias("lo"), F.max("proof").alias("hi"),
            F.max("n_bytes").alias("n_bytes")).filter("n > 1"), "repeated-rows")
        if again.filter("lo != hi").isEmpty():
            return Identity(salt, again.select("doc_id", "th", "n_bytes"))


def keyed_texts(docs: DataFrame, th: Column) -> DataFrame:
    """(doc_id, th, text as UTF-8 bytes): ``th`` tells apart rows that share a doc_id.

    A null doc_id becomes ``NULL_ID``, a null text the empty text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(id_key().alias("doc_id"), th.alias("th"), text.cast("binary").alias("text"))


def id_key() -> Column:
    """doc_id, or ``NULL_ID`` where it is null."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))


def text_digest() -> Column:
    """64 bits of the text: with ``id_key`` they name a document where very many rows share an id."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document (``id_key``, ``text_digest``) isn't among ``gone`` (doc_id, th)."""
    gone = gone.select(opaque(F.col("doc_id")).alias("_gone_id"), opaque(F.col("th")).alias("_gone_th"))
    same = (opaque(id_key()) == gone["_gone_id"]) & (opaque(text_digest()) == gone["_gone_th"])
    return docs.join(gone, same, "left_anti")


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts (sizes the partitioning; one cheap column scan)."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]

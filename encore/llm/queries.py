"""Queries of the training-data operators over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate, fingerprint, jaccard, langid, minhash, periodic, quality, sentencepiece_table, sharding, suffixarray, superkmer,
    trie, warc,
)
from .sql import ORACLES  # noqa: F401
from .tables import read


def sentencepiece_model() -> str:
    """Where the public tokenizer's model lies on every machine of the cluster."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compared(read(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_table.digests(read(spark, sf_dir, "documents"), sentencepiece_model())


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(read(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixarray.digests(read(spark, sf_dir, "documents"))


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer.digests(read(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(read(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_trie(read(spark, sf_dir, "conversations"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_warc, op2_fingerprints, op3_minhash, op4_sentencepiece, op5_langid, op6_decontamination, op7_sharding,
    op8_quality, op9_suffix_array, op10_substring, op11_periodic_runs,
    op12_prefix_trie, op13_ngram_join)}

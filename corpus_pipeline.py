"""A training-data pipeline of five operators, each on what the one before kept.

``run`` applies the stages to ``documents``. Each stage is written and read
again by a runner; here a stored table under the shared checkpoint folder
stands between them. All stages return the columns of ``documents``, the last
one adds the ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from encore.llm import decontaminate, minhash, quality, sentencepiece_table, superkmer
from encore.llm.queries import sentencepiece_model
from encore.llm.tables import id_key, opaque, read, stored, text_digest, without

#: Near duplicates share at least this percentage of their five-word shingles.
PERCENT = 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the document with the smallest doc_id, of each group of near duplicates; textless rows stay.

    Documents are told apart by doc_id and text. Of rows that agree in both
    any one stays.
    """
    found = stored(minhash.grouped(docs, PERCENT), "groups")
    kept = without(docs, found.filter("not kept"))
    again = found.filter("kept and n > 0").groupBy("doc_id", "th").count().filter("count > 1")
    if again.isEmpty():
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = kept.select(id_key().alias("doc_id"), text_digest().alias("th"), row)
    named = again.select(opaque(F.col("doc_id")).alias("_id"), opaque(F.col("th")).alias("_th"))
    same = (opaque(keyed["doc_id"]) == named["_id"]) & (opaque(keyed["th"]) == named["_th"])
    # F.first combines in each task, so a document stated very often is no hot key.
    one = keyed.join(named, same, "left_semi").groupBy("doc_id", "th").agg(F.first("row").alias("row"))
    return without(kept, again).unionAll(one.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 20-word passages that stand earlier in the corpus."""
    return superkmer.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminate.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``n_tokens``, ``ids`` and ``decoded``; where the input has such a column, ``encoded_ids`` etc."""
    out = sentencepiece_table.encode(docs, sentencepiece_model())
    taken, added = {c.lower() for c in docs.columns}, []
    for c in ("n_tokens", "ids", "decoded"):
        name = c
        while name in taken:
            name = f"encoded_{name}"
        added.append(F.col(c).alias(name))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], *added)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("substrings", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("tokens", encoded),
]

#: The quality model and the library's ids can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs

"""Language identification by multinomial naive Bayes (operator 5).

Features are hashed runs of one to three code points of the lower-cased
text. Counts by language come from all learning rows; the matrix of
log-probabilities (languages x ``BUCKETS``) goes to the tasks, which score
documents by their sparse counts, a batch of documents at a time.

Any number of languages will do: a matrix holds ``BLOCK_LANGUAGES`` of them at
most (256 x 16384 x 4 bytes = 16 MB), and with more the documents pass one
matrix after the other, carrying the best language so far.

Defined cases: a null text or one without a letter is ``und`` with score 0;
ties go to the language first in order; a null doc_id is not held out; with
nothing to learn from everything is ``und``; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .tables import stored, tidy

BUCKETS, BLOCK_LANGUAGES, SMOOTHING = 1 << 14, 256, 0.5
UNKNOWN = "und"
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_LETTER = re.compile(r"[^\W\d_]")
_PIECE = 1 << 18
#: Products of counts and log-probabilities that are held at once.
_PRODUCTS = 1 << 20


def held_out(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    """Whether crc32 of doc_id as text leaves ``part`` when divided by ``parts``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def gram_counts(text: str) -> np.ndarray:
    """Counts by bucket of all runs of one to three code points of a whole text."""
    total = np.zeros(BUCKETS, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    for at in range(0, len(points), _PIECE):
        part = points[at:at + _PIECE + 2]
        h = np.zeros(len(part), np.uint32)
        for n, factor in enumerate(_FACTORS):
            h = (h[:len(part) - n] ^ part[n:]) * factor
            h ^= h >> np.uint32(15)
            total += np.bincount(h[:_PIECE] & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    return total


def counted(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all rows with a language; bucket -1 counts documents."""

    def rows(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, n in totals.items():
            some = np.flatnonzero(n)
            bucket = np.where(some == BUCKETS, -1, some).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(bucket), pa.array(n[some])], ["lang", "bucket", "n"])
        totals.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                if lang not in totals and len(totals) == BLOCK_LANGUAGES:
                    yield from rows(totals)
                mine = totals.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
                mine[:-1] += gram_counts(text.as_py())
                mine[-1] += 1
        yield from rows(totals)

    learned = docs.filter("lang is not null and text is not null").select("lang", "text")
    return learned.mapInArrow(tidy(count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    """Some languages in order, their log-priors and log-probabilities (bucket x language)."""

    langs: list[str]
    prior: np.ndarray
    logs: np.ndarray


def fitted(docs: DataFrame, block: int = BLOCK_LANGUAGES) -> list[Model]:
    """Models of ``block`` languages each, all languages in order."""
    table = stored(counted(docs), "language-counts")
    sizes = {r.lang: r.n for r in table.filter("bucket = -1").collect()}  # a row for each language
    langs, total, models = sorted(sizes), sum(sizes.values()), []
    for at in range(0, len(langs), block):
        some = langs[at:at + block]
        place = {x: i for i, x in enumerate(some)}
        rows = table.filter(F.col("lang").isin(some) & (F.col("bucket") >= 0)).toPandas()  # block x BUCKETS at most
        grams = np.full((BUCKETS, len(some)), SMOOTHING)
        grams[rows["bucket"].to_numpy(), rows["lang"].map(place).to_numpy(np.int64)] += rows["n"].to_numpy()
        models.append(Model(some, np.log(np.array([sizes[x] for x in some]) / total),
                            np.log(grams / grams.sum(0)).astype(np.float32)))
    return models


def totals(model: Model, counts: list[np.ndarray]) -> np.ndarray:
    """Log-prior and log-probability of each document (its counts by bucket) in each language."""
    some = [np.flatnonzero(n) for n in counts]
    sizes = np.array([len(x) for x in some])
    at = np.concatenate(some)
    weights = np.concatenate([n[x] for n, x in zip(counts, some, strict=True)])
    products = model.logs[at].astype(np.float64) * weights[:, None]
    return model.prior + np.add.reduceat(products, np.cumsum(sizes) - sizes, axis=0)


_FOUND = "doc_id long, lang_pred string, top double, mass double"


def scored(docs: DataFrame, model: Model, last: bool) -> DataFrame:
    """The best language so far, its total and the mass of all languages against it; without the text at last."""

    def settle(out: dict, rows: list[int], counts: list[np.ndarray]) -> None:
        if not rows:
            return
        t = totals(model, counts)
        best = np.argmax(t, 1)
        top = t[np.arange(len(t)), best]
        mass = np.exp(t - top[:, None]).sum(1)
        for row, k, x, m in zip(rows, best, top, mass, strict=True):
            lang, before, held = out["lang_pred"][row], out["top"][row], out["mass"][row]
            if lang == UNKNOWN:
                lang, before, held = model.langs[k], x, 0.0
            elif x > before:
                lang, before, held = model.langs[k], x, held * np.exp(before - x)
            out["lang_pred"][row], out["top"][row] = lang, before
            out["mass"][row] = held + m * np.exp(x - before)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: batch.column(c).to_pylist() for c in ("lang_pred", "top", "mass")}
            rows, counts, held = [], [], 0
            for row, text in enumerate(batch.column("text")):
                text = text.as_py()
                if text is None or not _LETTER.search(text):
                    continue
                n = gram_counts(text)
                rows.append(row)
                counts.append(n)
                held += np.count_nonzero(n) * len(model.langs)
                if held > _PRODUCTS:
                    settle(out, rows, counts)
                    rows, counts, held = [], [], 0
            settle(out, rows, counts)
            kept = [batch.column("doc_id")] if last else [batch.column("text"), batch.column("doc_id")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(out["lang_pred"], pa.string()), pa.array(out["top"], pa.float64()),
                 pa.array(out["mass"], pa.float64())], (["doc_id"] if last else ["text", "doc_id"]) + ["lang_pred", "top", "mass"])

    return docs.mapInArrow(tidy(score), _FOUND if last else f"text string, {_FOUND}")


def predicted(docs: DataFrame, models: list[Model]) -> DataFrame:
    """doc_id, lang_pred, score (posterior of the language) of each row."""
    found = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"),
                        F.lit(0.0).alias("top"), F.lit(0.0).alias("mass"))
    for i, model in enumerate(models):
        found = scored(found, model, i == len(models) - 1)
    score = F.when(F.col("mass") > 0, 1 / F.col("mass")).otherwise(F.lit(0.0))
    return found.select("doc_id", "lang_pred", score.alias("score"))


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from the rows that aren't held out."""
    models = fitted(docs.filter(~held_out(F.col("doc_id"))))
    return predicted(docs, models).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

"""Benchmark decontamination by spaced seeds (operator 6).

A document overlaps a benchmark item where ``WINDOW`` consecutive words of
both, aligned, agree in all but ``MISMATCHES`` positions (A-Z lower-cased).
Two fixed masks choose six of eight consecutive words and ignore the others;
together they leave a whole hit in every such window, wherever the
substitutions are (``tests/llm`` tries all patterns). Items of fewer words
than a window are sought whole, word for word.

The masks' hashes of the test items fill a Bloom filter of bounded size
(``MOST_BITS``) that is shipped to the tasks; a document's hash that passes it
travels with the words around it, and is joined with the items' hashes. The
filter only thins: whatever size the benchmark has, the join decides, and the
words around each hit verify the overlap.

Defined cases: null and empty texts overlap nothing; a null doc_id is kept as
null; several overlaps of a document with an item are one row; rows that agree
in doc_id and text are one document, rows that share a null or repeated doc_id
but not the text are documents of their own, each with rows of its own; other
columns are ignored; an empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytescan as b
from .tables import NULL_ID, keyed_texts, opaque, text_digest, tidy, without
from .windows import word_chunks

WINDOW, MISMATCHES = 13, 2
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 6, 7))
SPAN = 8
#: Words kept on each side of a hit: all of any window that holds it.
AROUND = WINDOW - SPAN
BLOOM_HASHES, BITS_PER_SEED, LEAST_BITS, MOST_BITS = 4, 64, 20, 27
_SALT = b.mix(np.arange(77, 77 + len(MASKS) + WINDOW, dtype=np.uint64))
_ROW = "doc_id long, th long, place long, hash long, around binary"


def word_hashes(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(doc_id, th, first word, word hashes) of each text, long ones in pieces that overlap by a window."""
    for chunk in word_chunks(batch, WINDOW, 1, lower=True):
        words = chunk.spans.every(1)
        for row in range(len(chunk.doc_id)):
            yield int(chunk.doc_id[row]), int(chunk.th[row]), int(chunk.base[row]), words[chunk.begin[row]:chunk.end[row]]


def masked(words: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """For each mask the hash at each place, and the mask's span."""
    n = len(words) - SPAN + 1
    for mask, salt in zip(MASKS, _SALT, strict=False):
        h = np.full(max(n, 0), salt)
        for at in mask:
            h = b.mix(h ^ words[at:at + max(n, 0)])
        yield h, SPAN


def whole(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each ``length`` words in a row, for items shorter than a window."""
    n = max(len(words) - length + 1, 0)
    h = np.full(n, _SALT[len(MASKS) + length - 1])
    for at in range(length):
        h = b.mix(h ^ words[at:at + n])
    return h


def around(words: np.ndarray, place: int, span: int) -> bytes:
    """Words from ``AROUND`` before a hit to ``AROUND`` after it; 0 where the text ends."""
    out = np.zeros(span + 2 * AROUND, np.uint64)
    lo, hi = max(place - AROUND, 0), min(place + span + AROUND, len(words))
    out[lo - place + AROUND:hi - place + AROUND] = words[lo:hi]
    return out.tobytes()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    ids, th, places, hashes, blobs = zip(*rows, strict=True) if rows else ((), (), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(th, pa.int64()), pa.array(places, pa.int64()),
         pa.array(np.array(hashes, np.uint64).view(np.int64), pa.int64()), pa.array(blobs, pa.binary())],
        ["doc_id", "th", "place", "hash", "around"])


def item_seeds(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_place, item_hash, item_around): the masked hashes of each item, at each place."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, th, base, words in word_hashes(batch):
                if 0 < len(words) < WINDOW and not base:
                    rows.append((item, th, 0, whole(words, len(words))[0], words.tobytes()))
                    continue
                for hashes, span in masked(words):
                    rows += [(item, th, base + i, h, around(words, i, span)) for i, h in enumerate(hashes)]
            yield _rows(rows)

    items = keyed_texts(benchmark.select(F.col("item_id").alias("doc_id"), "text"), th=text_digest())
    return items.mapInArrow(tidy(seeds), _ROW).select(
        F.col("doc_id").alias("item_id"), F.col("place").alias("item_place"), F.col("hash").alias("item_hash"),
        F.col("around").alias("item_around"))


def _bloom_slots(h: np.ndarray, bits: int) -> np.ndarray:
    step = b.mix(h ^ _SALT[0]) | np.uint64(1)
    return ((h[:, None] + np.arange(BLOOM_HASHES, dtype=np.uint64) * step[:, None])
            & np.uint64((1 << bits) - 1)).astype(np.int64)


def bloom(seeds: DataFrame) -> tuple[int, bytes, list[int]]:
    """Bits, filter and lengths of short items; the filter has 16 MB at most, made in pieces by the tasks."""
    count, lengths = seeds.agg(F.count("*"), F.collect_set(
        F.when(F.octet_length("item_around") < 8 * WINDOW, F.octet_length("item_around") / 8).cast("int"))).first()
    bits = int(np.clip(np.ceil(np.log2(max(1, count) * BITS_PER_SEED)), LEAST_BITS, MOST_BITS))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.unique(_bloom_slots(batch.column("item_hash").to_numpy().view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays([pa.array(got >> 18), pa.array(got & (1 << 18) - 1)], ["piece", "bit"])

    def piece(table: pa.Table) -> pa.Table:
        filled = np.zeros(1 << 18, bool)
        filled[table.column("bit").to_numpy()] = True
        return pa.table({"piece": table.column("piece").slice(0, 1),
                         "filled": pa.array([np.packbits(filled, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros(1 << bits - 3, np.uint8)
    pieces = (seeds.select("item_hash").mapInArrow(tidy(slots), "piece long, bit long").distinct()
              .groupBy("piece").applyInArrow(piece, "piece long, filled binary"))
    for at, filled in pieces.collect():  # 512 pieces of 32 KB at most
        out[at << 15:(at + 1) << 15] = np.frombuffer(filled, np.uint8)
    return bits, out.tobytes(), sorted(lengths)


def hits(docs: DataFrame, bits: int, filled: bytes, lengths: list[int]) -> DataFrame:
    """(doc_id, th, place, hash, around): hashes of documents that pass the filter."""

    def passing(h: np.ndarray) -> np.ndarray:
        table = np.frombuffer(filled, np.uint8)
        left = np.arange(len(h))
        step = b.mix(h ^ _SALT[0]) | np.uint64(1)
        for k in range(BLOOM_HASHES):
            slot = ((h[left] + np.uint64(k) * step[left]) & np.uint64((1 << bits) - 1)).astype(np.int64)
            left = left[(table[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)]
        return left

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in word_chunks(batch, WINDOW, 1, lower=True):
                words = chunk.spans.every(1)
                rows = []
                kinds = [*masked(words), *((whole(words, n), -n) for n in lengths)]
                for hashes, span in kinds:
                    for i in passing(hashes).tolist():
                        row = int(np.searchsorted(chunk.begin, i, "right")) - 1
                        if i + abs(span) > chunk.end[row]:
                            continue  # it runs into the next text
                        lo = int(chunk.begin[row])
                        own = words[lo:chunk.end[row]]
                        near = own[i - lo:i - lo - span].tobytes() if span < 0 else around(own, i - lo, span)
                        rows.append((int(chunk.doc_id[row]), int(chunk.th[row]), int(chunk.base[row]) + i - lo, hashes[i],
                                     near))
                yield _rows(rows)

    return keyed_texts(docs, th=text_digest()).mapInArrow(tidy(found), _ROW)


def verified(mine: bytes, theirs: bytes) -> tuple[int, int, int] | None:
    """(first, end, equal words) of the best overlap around a hit, by offset to the hit; None if there is none."""
    x, y = np.frombuffer(mine, np.uint64), np.frombuffer(theirs, np.uint64)
    if len(x) != len(y):
        return None
    equal = x == y
    if len(x) < WINDOW:  # a short item, whole
        return (0, len(x), len(x)) if equal.all() else None
    inside = (x != 0) & (y != 0)
    ends = np.concatenate(([0], np.cumsum(equal & inside)))
    full = np.concatenate(([0], np.cumsum(inside)))
    good = np.flatnonzero((ends[WINDOW:] - ends[:-WINDOW] >= WINDOW - MISMATCHES)
                          & (full[WINDOW:] - full[:-WINDOW] == WINDOW))
    if not len(good):
        return None
    lo, hi = int(good[0]), int(good[-1]) + WINDOW
    return lo - AROUND, hi - AROUND, int(ends[hi] - ends[lo])


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, th, item_id, first_word, end_word, n_hits) for each document that overlaps an item."""
    seeds = item_seeds(benchmark)
    bits, filled, lengths = bloom(seeds)
    mine = hits(docs, bits, filled, lengths)
    theirs = seeds.withColumn("item_hash", opaque(F.col("item_hash")))
    met = mine.join(theirs, opaque(F.col("hash")) == F.col("item_hash")).select(
        "doc_id", "th", "item_id", "place", "around", "item_around")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, first, end = [], [], []
            place = batch.column("place").to_numpy()
            for i, (x, y) in enumerate(zip(batch.column("around").to_pylist(),
                                           batch.column("item_around").to_pylist(), strict=True)):
                if span := verified(x, y):
                    keep.append(i)
                    first.append(int(place[i]) + span[0])
                    end.append(int(place[i]) + span[1])
            kept = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(kept) for c in ("doc_id", "th", "item_id")), pa.array(first, pa.int64()),
                 pa.array(end, pa.int64())], ["doc_id", "th", "item_id", "first_word", "end_word"])

    rows = met.mapInArrow(tidy(check), "doc_id long, th long, item_id long, first_word long, end_word long")
    return rows.groupBy("doc_id", "th", "item_id").agg(
        F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word"), F.count("*").alias("n_hits"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``overlaps`` with null ids restored."""
    def restored(c):
        return F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return overlaps(docs, benchmark).select(restored("doc_id"), restored("item_id"), "first_word", "end_word", "n_hits")


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item."""
    return without(docs, overlaps(docs, benchmark).select("doc_id", "th").distinct())

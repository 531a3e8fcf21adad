"""Substring dedup: super-k-mer partitioning of word windows (operator 10).

A window is ``WIDTH`` consecutive words of one document. Consecutive windows
that share a minimiser (of runs of ``SHORT`` words) travel as one packed
string to the bucket of that minimiser, and a bucket finds equal windows by
sorting; equal hashes are confirmed byte by byte. Each word that a window covers
whose words also start earlier (smaller doc_id, or the same document and an
earlier start) is removed. Windows are judged on the input.

Defined cases: a null text has no words; a text of fewer than ``WIDTH`` words
loses nothing; words are kept unchanged; white space is ASCII white space; a
null doc_id counts as the smallest; rows that agree in doc_id and text are one
document stated several times and get the same result (none starts earlier); rows
that share a doc_id with other texts are ordered by 64 bits of the text; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import bytescan as b
from .tables import identity, keyed_texts, text_bytes, text_key, tidy
from .windows import HOT_RECORDS, planned, repeats, united, with_spans, word_chunks

WIDTH, SHORT = 20, 3


def later_windows(fields: dict, place: np.ndarray, buf: np.ndarray, width: int = WIDTH):
    """(doc_id, th, start, end) of the windows in a bucket that repeat an earlier one."""
    ends = np.flatnonzero(buf == 0x20)
    starts = np.concatenate(([0], ends[:-1] + 1))
    at = np.append(starts, len(buf))
    spans = b.Spans(b.slice_hashes(buf, starts, ends))
    n = fields["windows"].astype(np.int64)
    first = np.searchsorted(starts, place)
    window = b.gathered(np.arange(len(starts)), first, n)
    hashes = spans(window, window + width)
    record = np.repeat(np.arange(len(n)), n)
    start = fields["start"][record] + window - first[record]
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return (np.zeros(0, np.int64),) * 4
    keep = twice[np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)] == hashes
    window, hashes, record, start = window[keep], hashes[keep], record[keep], start[keep]
    doc_id, th = fields["doc_id"][record], fields["th"][record]
    order = np.lexsort((start, th, doc_id, hashes))
    window, hashes, doc_id, th, start = (x[order] for x in (window, hashes, doc_id, th, start))
    new = np.concatenate(([True], hashes[1:] != hashes[:-1]))
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    lead = _confirmed(buf, at, window, lead, width)
    repeat = (doc_id != doc_id[lead]) | (th != th[lead]) | (start != start[lead])
    return doc_id[repeat], th[repeat], start[repeat], start[repeat] + width


def _confirmed(buf, at, window, lead, width):
    """For each window the first one with the same words, given the first with the same hash."""
    size = at[window + width] - at[window]
    same = size == size[lead]
    same[same] = b.same_slices(buf, at[window[same]], at[window[lead[same]]], size[same])
    seen: dict[bytes, int] = {}
    for i in np.flatnonzero(~same):  # a collision of hashes; rows come in order
        lead[i] = seen.setdefault(buf[at[window[i]]:at[window[i] + width]].tobytes(), i)
    return lead


def repeated_words(docs: DataFrame, width: int = WIDTH, short: int = SHORT,
                   hot_records: int = HOT_RECORDS) -> DataFrame:
    """``doc_id``, ``text`` and ``spans`` (of words to remove) for each row of ``docs``."""
    names = identity(docs)
    texts = keyed_texts(docs, text_key(names.salt))
    chunks = partial(word_chunks, width=width, short=short)
    run = (width - short + 2) / 2  # windows of a record on average
    plan = planned(texts, text_bytes(docs), chunks, width, (run + width - 1) / run, 6 * run, False, hot_records)
    spans = repeats(texts, plan, partial(later_windows, width=width), keep_first=True)
    return with_spans(docs, spans, names.salt)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (kept words joined by one blank)."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words_n, removed_n, shas = [], [], []
            for text, spans in zip(batch.column("bytes"), batch.column("spans"), strict=True):
                words = (text.as_py() or b"").split()
                start, end = united(spans.as_py())
                words_n.append(len(words))
                removed_n.append(int((end - start).sum()))
                kept, at = [], 0
                for x, y in zip(start.tolist(), end.tolist(), strict=True):
                    kept += words[at:x]
                    at = y
                shas.append(hashlib.sha256(b" ".join(kept + words[at:])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words_n, pa.int64()), pa.array(removed_n, pa.int64()),
                 pa.array(shas, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    marked = repeated_words(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return marked.select("doc_id", F.col("text").cast("binary").alias("bytes"), "spans").mapInArrow(tidy(per_batch), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_words(text: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    """``text`` without the words in the spans; white space after a removed word goes with it."""
    buf = np.frombuffer(text, np.uint8)
    starts, _ = b.words_of(buf)
    bounds = np.append(starts, len(buf))
    parts, at = [], 0
    for x, y in zip(bounds[start].tolist(), bounds[end].tolist(), strict=True):
        parts.append(text[at:x])
        at = y
    return b"".join([*parts, text[at:]])


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated words cut from ``text`` and ``n_chars`` counted anew."""
    packed = docs.select("doc_id", "text", F.struct("*").alias("row"))
    schema = T.StructType([T.StructField("_text", T.StringType()), packed.schema["row"]])

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("bytes"), batch.column("spans"), strict=True):
                start, end = united(spans.as_py())
                whole = text.as_py()
                texts.append(without_words(whole, start, end) if len(start) else whole)
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.binary()).cast(pa.string()), batch.column("row")], ["_text", "row"])

    out = repeated_words(packed).select(F.col("text").cast("binary").alias("bytes"), "spans", "row").mapInArrow(tidy(per_batch), schema)
    return out.select(*[F.col("_text").alias("text") if c == "text"
                        else F.length("_text").cast("long").alias("n_chars") if c == "n_chars"
                        else F.col(f"row.`{c}`").alias(c) for c in docs.columns])

"""Suffix-array dedup of byte strings (operator 9).

Each byte that a ``WIDTH``-byte string covers which also starts anywhere else
(same document included) is removed; strings are judged on the input.

Candidates are found by content, not by document: the windows of a minimiser
meet in one bucket (``windows``). A bucket drops minimisers that occur once,
unites equal slices, deals the rest into shards of bounded size and builds a
suffix array for each by Larsson-Sadakane refinement (only groups not yet
told apart are sorted again), finds common prefixes by Kasai's walk, run for
all slices side by side, and merges shards that hold parts of one minimiser
by binary search of the one's suffixes in the other's array.

Defined cases: a null text is empty; a text shorter than ``WIDTH`` loses
nothing; a null doc_id is kept as null; each row is a document, so rows that
agree in doc_id and text are copies of each other and lose all their bytes
(``WIDTH`` or more); a shared or null doc_id makes no copies of different texts;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytescan as b
from .tables import identity, keyed_texts, text_bytes, text_key, tidy
from .windows import HOT_RECORDS, byte_chunks, planned, repeats, united, whole_texts, with_spans

WIDTH, SHORT = 200, 32
#: Bytes of a shard, below 2**21 so that two ranks and a place fit one sort key.
SHARD_BYTES = 1 << 20
_FIRST = 5  # bytes told apart by the first sort
_BITS = np.uint64(21)
_LOW = np.uint64((1 << 21) - 1)


def suffix_array(buf: np.ndarray, left: np.ndarray, width: int) -> np.ndarray:
    """Places with ``left >= width``, sorted by their next ``width`` bytes.

    ``left`` counts the bytes up to the end of the slice a place is in.
    Ranks double their depth; a place whose rank is its own isn't sorted again.
    """
    n = len(buf)
    assert n <= int(_LOW)
    rank = np.zeros(n, np.uint64)
    depth = min(_FIRST, width)
    live = np.flatnonzero(left >= depth).astype(np.uint64)
    if not len(live):
        return np.zeros(0, np.int64)
    key = np.zeros(len(live), np.uint64)
    for i in range(depth):
        key = (key << np.uint64(8)) | buf[live.astype(np.int64) + i]
    key = np.sort((key << _BITS) | live)
    place, key = (key & _LOW).astype(np.int64), key >> _BITS
    new = np.concatenate(([True], key[1:] != key[:-1]))
    rank[place] = np.flatnonzero(new)[np.cumsum(new) - 1]
    again = place[_shared(new)]
    while depth < width and len(again):
        step = min(depth, width - depth)
        again = again[left[again] >= depth + step]
        if not len(again):
            break
        key = (rank[again] << (_BITS * np.uint64(2))) | (rank[again + step] << _BITS)
        key = np.sort(key | np.arange(len(again), dtype=np.uint64))
        place = again[(key & _LOW).astype(np.int64)]
        both, old = key >> _BITS, key >> (_BITS * np.uint64(2))
        index = np.arange(len(place))
        opens = np.concatenate(([True], old[1:] != old[:-1]))
        new = np.concatenate(([True], both[1:] != both[:-1]))
        offset = index[new][np.cumsum(new) - 1] - index[opens][np.cumsum(opens) - 1]
        rank[place] = old + offset.astype(np.uint64)
        again = place[_shared(new)]
        depth += step
    whole = np.flatnonzero(left >= width).astype(np.uint64)
    return (np.sort((rank[whole.astype(np.int64)] << _BITS) | whole) & _LOW).astype(np.int64)


def _shared(new: np.ndarray) -> np.ndarray:
    """Members of groups of two or more, given where groups begin."""
    return ~(new & np.concatenate((new[1:], [True])))


def _words(buf: np.ndarray) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(np.concatenate((buf, np.zeros(8, np.uint8))), 8)


def _word(words: np.ndarray, place: np.ndarray, kind: str) -> np.ndarray:
    return np.ascontiguousarray(words[place]).view(kind).ravel().astype(np.uint64)


def common_prefixes(buf: np.ndarray, order: np.ndarray, first: np.ndarray, windows: np.ndarray,
                    width: int) -> np.ndarray:
    """Kasai's common prefix of each place in ``order`` with the one before, ``width`` at most.

    Slices are walked side by side: step j handles the j-th place of each
    slice, and each carries its prefix, less one, to its next place. It can
    only where the neighbour's next place stands before its own in ``order``:
    places that agree in all ``width`` bytes are in no order beyond them.
    """
    words = _words(buf)
    before = np.full(len(buf), -1, np.int64)
    before[order[1:]] = order[:-1]
    index = np.full(len(buf) + 1, len(buf))
    index[order] = np.arange(len(order))
    out = np.zeros(len(buf), np.int64)
    lanes = np.argsort(-windows, kind="stable")
    first, windows = first[lanes], windows[lanes]
    have = np.zeros(len(first), np.int64)
    for j in range(int(windows[0]) if len(windows) else 0):
        n = int(np.searchsorted(-windows, -j, "left"))  # lanes with more than j windows
        place = first[:n] + j
        other = before[place]
        got = np.where(other >= 0, np.maximum(have[:n] - 1, 0), 0)
        open_ = np.flatnonzero((other >= 0) & (got < width))
        while len(open_):
            x = _word(words, place[open_] + got[open_], "<u8") ^ _word(words, other[open_] + got[open_], "<u8")
            lowest = (x & (~x + np.uint64(1))).astype(np.float64)
            equal = np.where(x == 0, 8, np.log2(np.where(x == 0, 1, lowest)).astype(np.int64) >> 3)
            got[open_] = np.minimum(got[open_] + equal, width)
            open_ = open_[(equal == 8) & (got[open_] < width)]
        out[place] = got
        have[:n] = np.where(index[other + 1] < index[place + 1], got, 0)
    return out[order]


def _compared(words: np.ndarray, a: np.ndarray, q: np.ndarray, width: int) -> np.ndarray:
    """-1, 0 or 1 as the ``width`` bytes at ``a`` stand to those at ``q``."""
    out = np.zeros(len(a), np.int8)
    open_, at = np.arange(len(a)), 0
    while at < width and len(open_):
        x, y = _word(words, a[open_] + at, ">u8"), _word(words, q[open_] + at, ">u8")
        if width - at < 8:
            cut = np.uint64(8 * (8 - (width - at)))
            x, y = x >> cut, y >> cut
        out[open_] = (x > y).astype(np.int8) - (x < y)
        open_ = open_[x == y]
        at += 8
    return out


def found_in(buf: np.ndarray, order: np.ndarray, query: np.ndarray, width: int) -> np.ndarray:
    """For each query place a place in the sorted ``order`` with equal bytes, or -1 (binary search)."""
    words = _words(buf)
    lo, hi = np.zeros(len(query), np.int64), np.full(len(query), len(order))
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) >> 1
        less = _compared(words, order[mid], query[open_], width) < 0
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]
    out = np.full(len(query), -1, np.int64)
    inside = np.flatnonzero(lo < len(order))
    equal = _compared(words, order[lo[inside]], query[inside], width) == 0
    out[inside[equal]] = order[lo[inside[equal]]]
    return out


def repeated_places(buf: np.ndarray, place: np.ndarray, size: np.ndarray, seed: np.ndarray, width: int,
                    shard_bytes: int = SHARD_BYTES) -> np.ndarray:
    """Marks the places of ``buf`` whose window stands in two of the slices, or twice in one.

    Slices come sorted by seed; equal windows have equal seeds.
    """
    marked = np.zeros(len(buf), bool)
    shards, i, n = [], 0, len(place)
    ends = np.cumsum(size)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - size[i] + shard_bytes, "right")))
        lo, hi = int(place[i]), int(place[j - 1] + size[j - 1])
        left = np.repeat(place[i:j] + size[i:j] - lo, size[i:j]) - np.arange(hi - lo)
        order = suffix_array(buf[lo:hi], left, width)
        common = common_prefixes(buf[lo:hi], order, place[i:j] - lo, size[i:j] - width + 1, width)
        twice = np.flatnonzero(common >= width)
        marked[lo + order[twice]] = marked[lo + order[twice - 1]] = True
        for s in range(len(shards) - 1, -1, -1):  # earlier shards that hold the first seed too
            if shards[s][1] != seed[i]:
                break
            k = i + int(np.searchsorted(seed[i:j], seed[i], "right"))
            query = b.gathered(np.arange(len(buf)), place[i:k], size[i:k] - width + 1)
            other = found_in(buf, shards[s][0], query, width)
            marked[query[other >= 0]] = True
            marked[other[other >= 0]] = True
        shards.append((lo + order, seed[j - 1]))
        i = j
    return marked


def repeated_windows(fields: dict, place: np.ndarray, buf: np.ndarray, width: int = WIDTH,
                     shard_bytes: int = SHARD_BYTES):
    """(doc_id, th, start, end) of the byte spans in a bucket that stand elsewhere too."""
    def rows(keep, f, p):
        return {k: v[keep] for k, v in f.items()}, p[keep]

    seeds, back, times = np.unique(fields["seed"], return_inverse=True, return_counts=True)
    fields, place = rows(np.flatnonzero(times[back] > 1), fields, place)
    size = fields["size"].astype(np.int64)
    if not len(size):
        return (np.zeros(0, np.int64),) * 4
    # Equal slices: only the first goes on; all are marked if they stand at two places.
    hashes = b.slice_hashes(buf, place, place + size)
    order = np.lexsort((fields["start"], fields["th"], fields["doc_id"], size, hashes, fields["seed"]))
    fields, place = rows(order, fields, place)
    size, hashes = size[order], hashes[order]
    ids, th, start = fields["doc_id"], fields["th"], fields["start"]
    new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (size[1:] != size[:-1])
                          | (fields["seed"][1:] != fields["seed"][:-1])))
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    same = b.same_slices(buf, place, place[lead], size)
    lead = np.where(same, lead, np.arange(len(lead)))  # a collision of hashes stands alone
    elsewhere = (ids != ids[lead]) | (th != th[lead]) | (start != start[lead])
    whole = np.zeros(len(lead), bool)
    whole[lead[elsewhere]] = True
    whole = whole[lead]
    first = np.flatnonzero(lead == np.arange(len(lead)))
    seeds, back, times = np.unique(fields["seed"][first], return_inverse=True, return_counts=True)
    first = first[times[back] > 1]
    text = b.gathered(buf, place[first], size[first])
    at = np.cumsum(size[first]) - size[first]
    marked = repeated_places(text, at, size[first], fields["seed"][first], width, shard_bytes)
    # Places back to documents: a window marked in the first of equal slices stands in all of them.
    found = np.flatnonzero(marked)
    row = np.searchsorted(at, found, "right") - 1
    hit = first[row]
    partly = ~whole[hit]
    hit, offset = hit[partly], (found - at[row])[partly]
    copies = np.flatnonzero(whole)
    return (np.concatenate((ids[copies], ids[hit])), np.concatenate((th[copies], th[hit])),
            np.concatenate((start[copies], start[hit] + offset)),
            np.concatenate((start[copies] + size[copies], start[hit] + offset + width)))


def repeated_bytes(docs: DataFrame, width: int = WIDTH, short: int = SHORT,
                   hot_records: int = HOT_RECORDS) -> DataFrame:
    """The rows of ``docs`` with ``spans`` (of bytes to remove)."""
    names = identity(docs)
    texts = keyed_texts(docs, text_key(names.salt))
    chunks = partial(byte_chunks, width=width, short=short)
    run = (width - short + 2) / 2
    plan = planned(texts, text_bytes(docs), chunks, width, (run + width - 1) / run, run, True, hot_records)
    spans = repeats(texts, plan, partial(repeated_windows, width=width), keep_first=False)
    if names.again is not None:  # equal rows have one name in the buckets: here they are several documents
        spans = spans.unionAll(whole_texts(names.again, width))
    return with_spans(docs, spans, names.salt)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the bytes that stay."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed_n, spans_n, shas = [], [], [], []
            for text, spans in zip(batch.column("bytes"), batch.column("spans"), strict=True):
                whole = text.as_py() or b""
                start, end = united(spans.as_py())
                kept, at = hashlib.sha256(), 0
                for x, y in zip(start.tolist(), end.tolist(), strict=True):
                    kept.update(whole[at:x])
                    at = y
                kept.update(whole[at:])
                sizes.append(len(whole))
                removed_n.append(int((end - start).sum()))
                spans_n.append(len(start))
                shas.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, removed_n, spans_n)),
                 pa.array(shas, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    marked = repeated_bytes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return marked.select("doc_id", F.col("text").cast("binary").alias("bytes"), "spans").mapInArrow(tidy(per_batch), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")

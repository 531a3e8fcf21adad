"""Document fingerprints by quartile bucket digests (operator 2).

Three-byte combinations within each five-byte window are hashed into
``BUCKETS`` buckets and counted. Each bucket becomes two bits: the quartile
its count falls into. A digest is the count of bytes on a log scale, the
shape of the quartiles and the 256 bits, as hexadecimal text. Digests are
compared by a bounded score: the sum over buckets of how many quartiles lie
between (whole-range jumps count double), plus capped differences of length
and shape; ``likeness`` falls from 1 at score 0 to 0 at ``UNLIKE``.

Defined cases: a null text is empty; texts of fewer than three bytes have no
triplets and a digest made from their bytes, so that different ones differ;
equal texts have equal digests; the document after the last is the first; a
single document follows itself; rows that share a doc_id follow each other in
the order of a hash of the text; null ids come first; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .bytescan import mix
from .tables import NULL_ID, stored, text_bytes, tidy

BUCKETS = 128
#: Distances between the first byte of a triplet and its others, within five bytes.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
_TABLES = (mix(np.arange(1, 6 * 3 * 256 + 1, dtype=np.uint64)) & np.uint64(BUCKETS - 1)).astype(np.uint8).reshape(
    len(TRIPLETS), 3, 256)
LENGTH_CAP, SHAPE_CAP = 24, 12
#: The largest possible score of two digests.
MOST = 6 * BUCKETS + LENGTH_CAP + 2 * SHAPE_CAP
_PIECE = 1 << 20
#: Text that one task sorts and scans.
TASK_BYTES = 64 << 20


def counts(text: bytes) -> np.ndarray:
    """How often triplets fall into each bucket, over the whole text."""
    total = np.zeros(BUCKETS, np.int64)
    data = np.frombuffer(text, np.uint8)
    for at in range(0, max(len(data) - 4, 1), _PIECE):
        part = data[at:at + _PIECE + 4]
        whole = at + _PIECE + 4 >= len(data)
        for (i, j), (a, b, c) in zip(TRIPLETS, _TABLES, strict=True):
            n = (len(part) - j) if whole else _PIECE
            if n > 0:
                total += np.bincount(a[part[:n]] ^ b[part[i:i + n]] ^ c[part[j:j + n]], minlength=BUCKETS)
    return total


def fingerprint(text: bytes) -> str:
    """2 hex digits of length, 2 of shape, 64 of quartiles; or a plain hash of a tiny text."""
    if len(text) < 3:
        return "ff" + hashlib.sha256(text).hexdigest()[:2 + BUCKETS // 2]
    n = counts(text)
    q1, q2, q3 = np.sort(n)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (n > q1).astype(np.uint8) + (n > q2) + (n > q3)
    length = min(254, int(np.log2(len(text)) * 8))
    top = max(int(q3), 1)
    shape = (int(q1) * 100 // top % 16) << 4 | (int(q2) * 100 // top % 16)
    packed = codes.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    return f"{length:02x}{shape:02x}{packed.astype(np.uint8).tobytes().hex()}"


def score(x: str, y: str) -> int:
    """Difference of two digests, from 0 to ``MOST``."""
    if x == y:
        return 0
    if x[:2] == "ff" or y[:2] == "ff":
        return MOST
    a, b = bytes.fromhex(x), bytes.fromhex(y)
    shape = sum(min((p - q) % 16, (q - p) % 16) * 2 for p, q in ((a[1] >> 4, b[1] >> 4), (a[1] & 15, b[1] & 15)))
    bits = [np.unpackbits(np.frombuffer(v[2:], np.uint8)).reshape(-1, 2) @ np.array([2, 1]) for v in (a, b)]
    apart = np.abs(bits[0].astype(int) - bits[1])
    return int(np.where(apart == 3, 6, apart).sum()) + min(abs(a[0] - b[0]), LENGTH_CAP) + min(shape, 2 * SHAPE_CAP)


#: Score at which likeness reaches 0: what unrelated texts come to, and less than ``MOST``.
UNLIKE = 200


def likeness(x: str, y: str) -> float:
    """1 for equal digests, falling with their score to 0 at ``UNLIKE``."""
    return max(0.0, 1.0 - score(x, y) / UNLIKE)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, part int, edge int, text string")
_KIND = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                   ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                   ("near_next", pa.float64()), ("part", pa.int32()), ("edge", pa.int32()), ("text", pa.string())])


def _row(doc_id, text: str, mine: str, following: str, theirs: str) -> tuple:
    other = edited(text, following)
    data = other.encode()
    changed = mine if other == text else fingerprint(data)
    return (doc_id, len(text), hashlib.sha256(data).hexdigest(), mine, changed, likeness(mine, changed),
            likeness(mine, theirs), None, None, None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), _KIND, strict=True)]
                                      if rows else [pa.array([], k.type) for k in _KIND], schema=_KIND)


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents are range-partitioned and sorted by doc_id once; a task pairs
    neighbours as they stream by. Its last document waits for the first of
    the next task: only these edges, two per task, are joined afterwards.
    """
    parts = max(1, text_bytes(docs) // TASK_BYTES + 1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                        F.hash(text).alias("th"), text.alias("text"))
    dealt = keyed.repartitionByRange(parts, "doc_id", "th").sortWithinPartitions("doc_id", "th")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        before = None
        for batch in batches:
            rows = []
            for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                value = value.as_py()
                mine = fingerprint(value.encode())
                if before is None:  # the first of this task
                    rows.append((doc_id, None, None, mine, None, None, None, part, 0, value))
                else:
                    rows.append(_row(*before, value, mine))
                before = (doc_id, value, mine)
            yield _batch(rows)
        if before is not None:
            yield _batch([(before[0], None, None, before[2], None, None, None, part, 1, before[1])])

    out = stored(dealt.select("doc_id", "text").mapInArrow(tidy(pairs), _OUT), "fingerprints")
    edges = out.filter("edge is not null")
    # The order of tasks: one number for each, which is all that this window sorts.
    tasks = edges.filter("edge = 0").select("part")
    everything = W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    follow = tasks.select("part", F.coalesce(F.lead("part").over(W.orderBy("part")),
                                             F.min("part").over(everything)).alias("next"))
    last = edges.filter("edge = 1").select("part", "doc_id", "text", "fingerprint")
    first = edges.filter("edge = 0").select(F.col("part").alias("next"), F.col("text").alias("next_text"),
                                            F.col("fingerprint").alias("next_fingerprint"))
    met = last.join(follow, "part").join(first, "next")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_row(r["doc_id"], r["text"], r["fingerprint"], r["next_text"], r["next_fingerprint"])
                    for r in batch.to_pylist()]
            yield _batch(rows)

    closed = met.mapInArrow(tidy(close), _OUT)
    return out.filter("edge is null").unionAll(closed).select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint",
        "edited_fingerprint", "near_edited", "near_next")

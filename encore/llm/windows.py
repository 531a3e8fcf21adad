"""Windows of texts dealt to buckets as packed strings, by their minimiser.

A window is a fixed number of consecutive units (bytes or words) of one
document. Consecutive windows with one minimiser form a *record*: one slice
of the text. Equal windows have equal minimisers, so they meet in the bucket
of that minimiser, and a bucket can decide about them alone.

Records travel in zstd blobs, one per bucket and map flush. Seeds of which
there are very many (a passage in a third of all documents) would swell one
bucket; ``hot_slots`` finds them in a first pass and their windows go another
way, as digests through Spark's own aggregation and join (``hot_windows``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from . import bytescan as b
from .tables import id_key, opaque, release, stored, text_key, tidy

#: Raw bytes of records that one bucket should hold.
BUCKET_BYTES = 4 << 20
#: Raw bytes of records that a map task gathers before it packs them.
FLUSH_BYTES = 24 << 20
#: Records of one slot of seeds from which it counts as hot (or 16 times the mean).
HOT_RECORDS = 16_384
SPANS = "doc_id long, th long, spans binary"


@dataclass
class Chunk:
    """Units of some texts in one buffer; unit i is ``buf[at[i]:at[i + 1]]``."""

    buf: np.ndarray
    at: np.ndarray
    begin: np.ndarray  # by row: its first unit
    end: np.ndarray  # and the unit after its last
    base: np.ndarray  # place of the first unit in the document
    doc_id: np.ndarray
    th: np.ndarray
    width: int
    seeds: np.ndarray  # hash of each short run of units from which minimisers come
    spans: b.Spans  # hashes of runs of units

    def runs(self):
        n = len(self.at) - 1
        edge = np.zeros(max(n - self.width + 1, 0) + 1, np.int8)
        whole = self.end - self.begin >= self.width
        edge[self.begin[whole]] += 1
        edge[self.end[whole] - self.width + 1] -= 1
        valid = np.cumsum(edge[:-1], dtype=np.int8) > 0
        short = n - len(self.seeds) + 1
        return b.minimiser_runs(self.seeds, self.width - short + 1, valid)

    def place(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc_id, th and place in the document of units."""
        row = np.searchsorted(self.begin, unit, "right") - 1
        return self.doc_id[row], self.th[row], unit - self.begin[row] + self.base[row]


def byte_chunks(batch: pa.RecordBatch, width: int, short: int) -> Iterator[Chunk]:
    """Chunks with bytes as units; a long text is cut into pieces that overlap."""
    buf, offsets = b.binary_parts(batch.column("text"))
    ids, th = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "th"))
    for i, j in b.groups_of_rows(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        step = 2 * b.CHUNK_BYTES
        for at in range(lo, max(hi - width + 1, lo + 1), step):
            stop = min(hi, at + step + width - 1)
            part = buf[at:stop]
            spans = b.byte_spans(part)
            one = hi - lo > step  # then it is a single row
            begin = np.zeros(1, np.int64) if one else offsets[i:j] - lo
            end = np.full(1, len(part)) if one else offsets[i + 1:j + 1] - lo
            yield Chunk(part, np.arange(len(part) + 1), begin, end,
                        np.full(j - i, at - lo), ids[i:j], th[i:j], width, spans.every(short), spans)


def _word_pieces(buf: np.ndarray, offsets: np.ndarray, width: int):
    """(rows, text buffer, word starts and ends, first word of the piece) of bounded pieces."""
    for i, j in b.groups_of_rows(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= 2 * b.CHUNK_BYTES:
            # A blank between the texts keeps the words of two rows apart.
            sizes = np.diff(offsets[i:j + 1])
            part = np.full(hi - lo + (j - i), 0x20, np.uint8)
            part[np.arange(hi - lo) + np.repeat(np.arange(j - i), sizes)] = buf[lo:hi]
            starts, ends = b.words_of(part)
            rows = offsets[i:j + 1] - lo + np.arange(j - i + 1)
            yield i, j, part, starts, ends, rows, 0
            continue
        at, base = lo, 0
        while True:
            stop = at
            while True:  # until the piece holds a window or the text ends
                stop = min(hi, stop + b.CHUNK_BYTES)
                while stop < hi and not b._SPACE[buf[stop]]:
                    stop += 1
                part = buf[at:stop]
                starts, ends = b.words_of(part)
                if len(starts) >= width or stop >= hi:
                    break
            yield i, j, part, starts, ends, np.array([0, len(part)]), base
            if stop >= hi:
                break
            base += len(starts) - width + 1
            at += int(np.append(starts, len(part))[len(starts) - width + 1])  # the last width - 1 words come again


def word_chunks(batch: pa.RecordBatch, width: int, short: int, lower: bool = False) -> Iterator[Chunk]:
    """Chunks with words as units, each word followed by one blank."""
    buf, offsets = b.binary_parts(batch.column("text"))
    ids, th = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "th"))
    for i, j, part, starts, ends, rows, base in _word_pieces(buf, offsets, width):
        if lower:
            part = b.LOWER[part]
        hashes = b.byte_spans(part)(starts, ends)
        padded = np.append(part, np.uint8(0x20))
        padded[ends] = 0x20
        lengths = ends - starts + 1
        words = b.gathered(padded, starts, lengths)
        at = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(lengths, out=at[1:])
        bounds = np.searchsorted(starts, rows)
        spans = b.Spans(hashes)
        yield Chunk(words, at, bounds[:-1], bounds[1:], np.full(j - i, base), ids[i:j], th[i:j],
                    width, spans.every(short), spans)


@dataclass(frozen=True)
class Plan:
    """How windows are dealt: fixed before any record travels."""

    chunks: Callable[[pa.RecordBatch], Iterator[Chunk]]
    buckets: int
    slot_bits: int
    hot: bytes  # one bit for each slot of seeds; empty: none is hot
    width: int  # units of a window
    seeded: bool  # whether records carry part of their seed

    def slots(self, seeds: np.ndarray) -> np.ndarray:
        return (b.mix(seeds) & np.uint64((1 << self.slot_bits) - 1)).astype(np.int64)

    def is_hot(self, seeds: np.ndarray) -> np.ndarray:
        if not self.hot or not len(seeds):
            return np.zeros(len(seeds), bool)
        slot = self.slots(seeds)
        return (np.frombuffer(self.hot, np.uint8)[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def planned(texts: DataFrame, total_bytes: int, chunks: Callable, width: int, swell: float, record_bytes: float,
            seeded: bool, hot_records: int = HOT_RECORDS) -> Plan:
    """Choose buckets by the data's size, then count seeds by slot to find the hot ones.

    ``swell`` is the size of all records against the texts, ``record_bytes``
    the text for each record; both only size things, results don't depend on them.
    The counts are sums over all records. Slots number about a thousandth of
    the records, 2**27 at most, so the bitmap of hot ones has 16 MB at most.
    """
    records = total_bytes / record_bytes
    bits = int(np.clip(np.ceil(np.log2(records / 1000 + 1)), 14, 27))
    plan = Plan(chunks, max(1, int(total_bytes * swell / BUCKET_BYTES)), bits, b"", width, seeded)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << plan.slot_bits, np.int64) if plan.slot_bits < 20 else None
        for batch in batches:
            for chunk in plan.chunks(batch):
                slots = plan.slots(chunk.runs()[2])
                if seen is not None:
                    seen += np.bincount(slots, minlength=len(seen))
                    continue
                got, n = np.unique(slots, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(got.astype(np.int32)), pa.array(n)], ["slot", "n"])
        if seen is not None:
            got = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(got.astype(np.int32)), pa.array(seen[got])], ["slot", "n"])

    counts = texts.mapInArrow(tidy(count), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    least = max(hot_records, int(16 * records / (1 << bits)))
    hot = [r[0] for r in counts.filter(F.col("n") > least).select("slot").collect()]
    if not hot:
        return plan
    bitmap = np.zeros(1 << bits, bool)
    bitmap[hot] = True
    return Plan(chunks, plan.buckets, bits, np.packbits(bitmap, bitorder="little").tobytes(), width, seeded)


_FIELDS = (("doc_id", np.int64), ("th", np.int64), ("start", np.int64), ("windows", np.int32),
           ("size", np.int32), ("seed", np.uint32))


#: Part of a seed that a record carries: a bucket has some ten thousand records,
#: so one in a thousand shares it by chance and is looked at for nothing.
_SEED = 0xFFFFFF


def _packed(parts: list[tuple[dict, np.ndarray]]) -> bytes:
    """Records as two zstd frames, fields and text, after the length of the first.

    Documents go as steps, sizes less the windows (constant where units are
    bytes), and each field byte by byte: all first bytes, all second ones, ...
    """
    fields = {name: np.concatenate([p[0][name] for p in parts]).astype(kind) for name, kind in _FIELDS}
    fields["doc_id"] = np.diff(fields["doc_id"], prepend=np.int64(0))
    fields["size"] = fields["size"] - fields["windows"]
    n = len(fields["size"])
    planes = [f.view(np.uint8).reshape(n, -1).T.tobytes() for f in fields.values()]
    pack = zstandard.ZstdCompressor(level=3)
    head = pack.compress(b"".join([n.to_bytes(8, "little"), *planes]))
    return b"".join([len(head).to_bytes(8, "little"), head, pack.compress(b"".join(p[1].tobytes() for p in parts))])


def unpacked(blobs: pa.ChunkedArray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Records of a bucket: their fields, each one's place in the buffer, the buffer."""
    fields: dict[str, list] = {name: [] for name, _ in _FIELDS}
    texts = []
    unpack = zstandard.ZstdDecompressor()
    for blob in blobs:
        raw = blob.as_py()
        cut = 8 + int.from_bytes(raw[:8], "little")
        head = unpack.decompress(raw[8:cut])
        n, at = int.from_bytes(head[:8], "little"), 8
        for name, kind in _FIELDS:
            planes = np.frombuffer(head, np.uint8, n * np.dtype(kind).itemsize, at)
            at += len(planes)
            fields[name].append(np.ascontiguousarray(planes.reshape(-1, n).T).view(kind).ravel())
        fields["doc_id"][-1] = np.cumsum(fields["doc_id"][-1])
        fields["size"][-1] = fields["size"][-1] + fields["windows"][-1]
        texts.append(np.frombuffer(unpack.decompress(raw[cut:]), np.uint8))
    out = {k: np.concatenate(v) for k, v in fields.items()}
    size = out["size"].astype(np.int64)
    return out, np.cumsum(size) - size, np.concatenate(texts)


def records(texts: DataFrame, plan: Plan) -> DataFrame:
    """(bucket, blob): all windows whose seed isn't hot, as packed strings."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0

        def flush():
            for bucket in sorted(held):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()), pa.array([_packed(held[bucket])], pa.binary())],
                    ["bucket", "blob"])
            held.clear()

        for batch in batches:
            for chunk in plan.chunks(batch):
                first, last, seed = chunk.runs()
                cold = ~plan.is_hot(seed)
                first, last, seed = first[cold], last[cold], seed[cold]
                mixed = b.mix(seed)
                bucket = (mixed >> np.uint64(32)).astype(np.int64) % plan.buckets
                order = np.argsort(bucket, kind="stable")
                first, last, mixed, bucket = first[order], last[order], mixed[order], bucket[order]
                doc_id, th, start = chunk.place(first)
                lo = chunk.at[first]
                sizes = chunk.at[last + chunk.width] - lo
                text = b.gathered(chunk.buf, lo, sizes)
                fields = {"doc_id": doc_id, "th": th, "start": start, "windows": last - first + 1,
                          "size": sizes, "seed": mixed & np.uint64(_SEED if plan.seeded else 0)}
                ends = np.cumsum(sizes)
                names, cuts = np.unique(bucket, return_index=True)
                for name, x, y in zip(names.tolist(), cuts, np.append(cuts, len(bucket))[1:], strict=True):
                    held.setdefault(name, []).append(
                        ({k: v[x:y] for k, v in fields.items()}, text[ends[x] - sizes[x]:ends[y - 1]]))
                size += len(text)
                if size >= FLUSH_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    return texts.mapInArrow(tidy(pack), "bucket int, blob binary")


_HOT = "d1 long, d2 long, doc_id long, th long, start long, spans binary"
#: Hot windows that a map task gathers before it unites equal ones.
HOT_FLUSH = 400_000


def _united(rows: list[tuple], keep_first: bool, width: int) -> Iterator[pa.RecordBatch]:
    """Of equal windows the first, and at once the spans that its equals in this task settle."""
    d1, d2, doc_id, th, start = (np.concatenate(c) for c in zip(*rows, strict=True))
    order = np.lexsort((start, th, doc_id, d2, d1))
    d1, d2, doc_id, th, start = (x[order] for x in (d1, d2, doc_id, th, start))
    new = np.concatenate(([True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])))
    first = np.flatnonzero(new)
    lead = first[np.cumsum(new) - 1]
    other = (doc_id != doc_id[lead]) | (th != th[lead]) | (start != start[lead])
    several = np.zeros(len(d1), bool)
    several[lead[other]] = True
    settled = other if keep_first else several[lead]
    yield pa.RecordBatch.from_arrays(
        [pa.array(d1[first]), pa.array(d2[first]), pa.array(doc_id[first]), pa.array(th[first]),
         pa.array(start[first]), pa.nulls(len(first), pa.binary())],
        ["d1", "d2", "doc_id", "th", "start", "spans"])
    spans = span_rows(doc_id[settled], th[settled], start[settled], start[settled] + width)
    none = pa.nulls(spans.num_rows, pa.int64())
    yield pa.RecordBatch.from_arrays(
        [none, none, spans.column(0), spans.column(1), none, spans.column(2)],
        ["d1", "d2", "doc_id", "th", "start", "spans"])


def hot_windows(texts: DataFrame, plan: Plan, keep_first: bool) -> DataFrame:
    """A 128-bit digest for each distinct window with a hot seed of each task, and settled spans."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for chunk in plan.chunks(batch):
                first, last, seed = chunk.runs()
                hot = plan.is_hot(seed)
                if not hot.any():
                    continue
                n = last[hot] - first[hot] + 1
                unit = b.gathered(np.arange(len(chunk.at)), first[hot], n)
                middle = unit + chunk.width // 2
                d1 = chunk.spans(unit, unit + chunk.width)
                d2 = b.mix(chunk.spans(unit, middle) ^ b.mix(chunk.spans(middle, unit + chunk.width)))
                rows.append((d1.view(np.int64), d2.view(np.int64), *chunk.place(unit)))
                size += len(unit)
                if size >= HOT_FLUSH:
                    yield from _united(rows, keep_first, plan.width)
                    rows, size = [], 0
        if rows:
            yield from _united(rows, keep_first, plan.width)

    return texts.mapInArrow(tidy(digests), _HOT)


def hot_repeats(texts: DataFrame, plan: Plan, keep_first: bool) -> DataFrame:
    """Spans of hot windows that occur at several places (``keep_first``: at an earlier one).

    Each task unites its equal windows; what is left is counted by digest
    (combining before the shuffle) and joined back. The join splits hot
    digests by AQE, as both of its sides are plain shuffles.
    """
    found = stored(hot_windows(texts, plan, keep_first), "hot-windows")
    rows = found.filter("spans is null").drop("spans")
    at = F.struct("doc_id", "th", "start")
    equal = rows.groupBy("d1", "d2").agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    equal = equal.filter("lo != hi").select(opaque(F.col("d1")).alias("k1"), opaque(F.col("d2")).alias("k2"), "lo")
    met = rows.join(equal, (opaque(rows.d1) == equal.k1) & (opaque(rows.d2) == equal.k2))
    if keep_first:
        met = met.filter(at != F.col("lo"))
    width = F.lit(plan.width).cast("long")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, end, th, ids = (batch.column(c).to_numpy() for c in ("start", "end", "th", "doc_id"))
            yield span_rows(ids, th, start, end)

    across = met.select("doc_id", "th", "start", (F.col("start") + width).alias("end")).mapInArrow(tidy(pairs), SPANS)
    return across.unionAll(found.filter("spans is not null").select("doc_id", "th", "spans"))


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open spans as maximal ones, in order."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    if not len(start):
        return start, reach
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    return start[new], reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(start) - 1]))]


def span_rows(doc_id: np.ndarray, th: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """One row per document with its spans, united, as pairs of 64-bit integers."""
    order = np.lexsort((start, th, doc_id))
    doc_id, th, start, end = doc_id[order], th[order], start[order], end[order]
    ids, hashes, blobs = [], [], []
    if len(doc_id):
        new = np.flatnonzero(np.concatenate(([True], (doc_id[1:] != doc_id[:-1]) | (th[1:] != th[:-1]))))
        for x, y in zip(new, [*new[1:], len(doc_id)], strict=True):
            ids.append(doc_id[x])
            hashes.append(th[x])
            blobs.append(np.stack(merged(start[x:y], end[x:y]), 1).astype(np.int64).tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(blobs, pa.binary())],
        ["doc_id", "th", "spans"])


def repeats(docs_texts: DataFrame, plan: Plan, decide: Callable[[dict, np.ndarray, np.ndarray], tuple],
            keep_first: bool) -> DataFrame:
    """(doc_id, th, spans): what ``decide`` marks in each bucket, and the hot windows' part."""

    def bucket(table: pa.Table) -> pa.Table:
        out = pa.Table.from_batches([span_rows(*decide(*unpacked(table.column("blob"))))])
        release()
        return out

    out = records(docs_texts, plan).groupBy("bucket").applyInArrow(bucket, SPANS)
    return out.unionAll(hot_repeats(docs_texts, plan, keep_first)) if plan.hot else out


def with_spans(docs: DataFrame, spans: DataFrame, salt: int | None) -> DataFrame:
    """The rows of ``docs`` with ``spans``: an array of blobs, null where nothing is marked."""
    mine = spans.groupBy(opaque(F.col("doc_id")).alias("_id"), opaque(F.col("th")).alias("_th")).agg(
        F.collect_list("spans").alias("spans"))
    same = (opaque(id_key()) == mine["_id"]) & (opaque(text_key(salt)) == mine["_th"])
    return docs.join(mine, same, "left").drop("_id", "_th")


def whole_texts(again: DataFrame, width: int) -> DataFrame:
    """(doc_id, th, spans): all of each text of ``again`` that holds a window."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, th, ends = (batch.column(c).to_numpy() for c in ("doc_id", "th", "n_bytes"))
            yield span_rows(ids, th, np.zeros(len(ids), np.int64), ends)

    return again.filter(F.col("n_bytes") >= width).mapInArrow(rows, SPANS)


def united(blobs) -> tuple[np.ndarray, np.ndarray]:
    """The union of the spans in a list of blobs."""
    if blobs is None or not len(blobs):
        none = np.zeros(0, np.int64)
        return none, none
    pairs = np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2)
    return merged(pairs[:, 0], pairs[:, 1])

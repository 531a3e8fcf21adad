"""SentencePiece ids by a table of distinct chunks (operator 4).

The model's normaliser is the identity with a leading marker, and no piece
holds a white-space marker after another character (``chunks_are_closed``
checks both). So pieces can't cross from a character to a marker: a text is
a row of chunks, each some markers and what follows up to the next marker,
and the ids of a text are its chunks' ids, one after the other. A group of
texts is cut into chunks by one scan of its bytes; Arrow's dictionary encoding
gives its distinct chunks and the place of each; a task's table segments each
distinct chunk once, with the library; and ids and decoded bytes are joined
back by position in one gather. A table of ``TABLE_CHUNKS`` entries that is
full keeps those that came up again, which bounds memory and changes no
result. It goes with its task: an executor has more Python workers than cores
(each is kept for later stages), and none holds a table while others work.

Defined cases: a null text is empty; an empty text has the end id alone;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from . import bytescan as b
from .tables import tidy

MARK = "▁"
TABLE_CHUNKS = 600_000
#: Bytes of text that are cut and joined at once.
GROUP_BYTES = 1 << 20


@lru_cache(maxsize=2)
def processor(model: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=model)


def chunks_are_closed(model: str) -> bool:
    """Whether chunks can be segmented alone with this model."""
    sp = processor(model)
    if any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(sp.get_piece_size())):
        return False
    probe = "  a  Ａ é\tﬁ\n "
    return sp.decode(sp.encode(probe)) == probe


@lru_cache(maxsize=2)
def vocabulary(sp) -> tuple[list[str], list[str], set[int]]:
    """The model's pieces, its ids as decimals, and the ids that don't stand for their piece."""
    ids = range(sp.get_piece_size())
    special = {i for i in ids if sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i)}
    return [sp.id_to_piece(i) for i in ids], [f"{i} " for i in ids], special


class Table:
    """Distinct chunks (as bytes) and what they stand for: count of ids, the ids packed, the decoded bytes.

    Ids are packed as 32-bit integers (``whole``) or as decimals, each
    followed by a blank.
    """

    def __init__(self, sp, whole: bool = False):
        self.sp, self.whole = sp, whole
        self.entries: dict[bytes, tuple[int, bytes, bytes]] = {}
        self.again: set[bytes] = set()  # came up in a later group too
        self.pieces, self.decimals, self.special = vocabulary(sp)

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, np.int32).tobytes() if self.whole else "".join([self.decimals[i] for i in ids]).encode()

    def _segment(self, chunks: list[bytes]) -> list[tuple[int, bytes, bytes]]:
        """The library puts one marker before any text; it stands for the first blank of a chunk."""
        texts = [c.decode() for c in chunks]
        coded = self.sp.encode([t[1:] for t in texts], num_threads=1)
        if " " in texts:
            coded[texts.index(" ")] = [self.sp.piece_to_id(MARK)]
        pieces, odd = self.pieces, []
        out = []
        for i, (chunk, text, ids) in enumerate(zip(chunks, texts, coded)):
            out.append((len(ids), self.packed(ids), chunk))
            if not self.special.isdisjoint(ids) or "".join([pieces[k] for k in ids]).replace(MARK, " ") != text:
                odd.append(i)
        # Decoding drops the first marker's blank; it is a blank of the chunk.
        for i, text in zip(odd, self.sp.decode([coded[i] for i in odd], num_threads=1) if odd else ()):
            out[i] = (*out[i][:2], b" " + text.encode())
        return out

    def look_up(self, chunks: list[bytes]) -> list[tuple[int, bytes, bytes]]:
        """Entries of distinct chunks."""
        entries = self.entries
        found = [entries.get(c) for c in chunks]
        new = [i for i, e in enumerate(found) if e is None]
        if len(new) < len(chunks):
            self.again.update([c for c, e in zip(chunks, found) if e is not None])
        for i, entry in zip(new, self._segment([chunks[i] for i in new])):
            found[i] = entry
        if len(entries) + len(new) > TABLE_CHUNKS:
            self.entries = entries = {c: entries[c] for c in self.again}
            self.again = set()
            if 2 * len(entries) > TABLE_CHUNKS:  # too many came up again: begin anew
                entries.clear()
        if len(entries) + len(new) <= TABLE_CHUNKS:
            entries.update((chunks[i], found[i]) for i in new)
        return found


def _cut(buf: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The chunks of some texts, one after the other, and how many each text has; a blank stands before each text."""
    sizes = np.diff(offsets)
    rows = np.flatnonzero(sizes)
    part = np.full(int(sizes.sum()) + len(rows), 0x20, np.uint8)
    lo = int(offsets[0])
    ends = np.cumsum(sizes[rows] + 1)
    first = ends - sizes[rows] - 1
    part[np.arange(len(part) - len(rows)) + np.repeat(np.arange(1, len(rows) + 1), sizes[rows])] = buf[lo:int(offsets[-1])]
    blank = part == 0x20
    start = blank.copy()
    start[1:] &= ~blank[:-1]
    start[first] = True
    at = np.flatnonzero(start)
    bounds = np.append(at, len(part)).astype(np.int32)
    counts = np.zeros(len(sizes), np.int64)
    counts[rows] = np.diff(np.append(np.searchsorted(at, first), len(at)))
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(part)]), counts


def _joined(parts: list[bytes], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts numbered ``which``, one after the other, as a buffer and the end of each."""
    lengths = np.array([len(p) for p in parts], np.int64)
    flat = np.frombuffer(b"".join(parts), np.uint8)
    return b.gathered(flat, (np.cumsum(lengths) - lengths)[which], lengths[which]), np.cumsum(lengths[which])


def encoded(texts: pa.Array, table: Table, end_id: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Count of ids, packed ids (the end id last) and decoded bytes of each text, as the library gives."""
    texts = pc.replace_substring(texts, MARK, " ").cast(pa.binary())
    buf, offsets = b.binary_parts(texts)
    for i, j in b.groups_of_rows(offsets, GROUP_BYTES):
        chunks, counts = _cut(buf, offsets[i:j + 1])
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        found = table.look_up(distinct)
        changed = any(f[2] != c for f, c in zip(found, distinct))  # else the texts decode to themselves
        found.append((1, table.packed([end_id]), b""))
        ends = np.cumsum(counts)
        which = np.insert(coded.indices.to_numpy(), ends, len(found) - 1)  # the end id behind each text
        rows = ends + np.arange(1, j - i + 1)
        sums = np.cumsum(np.array([f[0] for f in found])[which])[rows - 1]
        ids, id_ends = _joined([f[1] for f in found], which)
        id_ends = np.append(0, id_ends[rows - 1]).tolist()
        sizes = np.diff(np.append(0, sums)).tolist()
        if changed:
            decoded, text_ends = _joined([f[2] for f in found], which)
            starts, text_ends = np.append(0, text_ends[rows - 1])[:-1] + 1, text_ends[rows - 1]
        else:
            decoded, starts, text_ends = buf, offsets[i:j], offsets[i + 1:j + 1]
        ids, decoded = ids.data, decoded.data
        for k, (x, y) in enumerate(zip(starts.tolist(), text_ends.tolist())):
            yield sizes[k], bytes(ids[id_ends[k]:id_ends[k + 1]]), bytes(decoded[x:y])


def _run(batches: Iterator[pa.RecordBatch], model: str, whole: bool) -> Iterator[pa.RecordBatch]:
    table = Table(processor(model), whole)
    end = table.sp.eos_id()
    for batch in batches:
        counts, ids, texts = [], [], []
        for n, packed, decoded in encoded(pc.fill_null(batch.column("text"), ""), table, end):
            counts.append(n)
            ids.append(np.frombuffer(packed, np.int32) if whole else hashlib.sha256(packed[:-1]).hexdigest())
            texts.append(decoded.decode() if whole else hashlib.sha256(decoded).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(counts, pa.int64()),
             pa.array(ids, pa.list_(pa.int32()) if whole else pa.string()), pa.array(texts, pa.string())],
            ["row", "n_tokens", "ids", "decoded"])


def _applied(docs: DataFrame, row: list[str], model: str, whole: bool) -> DataFrame:
    if not chunks_are_closed(model):
        raise ValueError("pieces of this model cross white-space markers; chunks can't be segmented alone")
    kept = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in row]).alias("row"))
    ids = T.ArrayType(T.IntegerType()) if whole else T.StringType()
    schema = T.StructType([kept.schema["row"], T.StructField("n_tokens", T.LongType()), T.StructField("ids", ids),
                           T.StructField("decoded", T.StringType())])
    return kept.mapInArrow(tidy(partial(_run, model=model, whole=whole)), schema)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_tokens``, ``ids`` and ``decoded`` text of each row."""
    return _applied(docs, docs.columns, model, True)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return _applied(docs, ["doc_id"], model, False).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "n_tokens", F.col("ids").alias("ids_sha256"),
        F.col("decoded").alias("decoded_sha256"))

"""Periodic runs of words by a suffix automaton with link-cut access (operator 11).

A run is a stretch of consecutive words with smallest period q, of at least
``LEAST`` words and ``PERIODS`` periods, that no neighbouring word extends.
For each stretch of repeating words, a suffix automaton is built over its
words and its link tree held as link-cut preferred paths, each path with one
colour: the word at which its strings ended last. Appending word i accesses
the state of the prefix; every path segment met on the way to the root gives
the previous end c of its strings and their greatest length n. If the
distance i - c is within n the two occurrences overlap or touch, which is a
square; if n reaches ``PERIODS - 1`` distances, the run through it is long
enough and is extended to both sides, once. The segments are then recoloured
i. The last occurrence is the nearest, so the distance is the smallest
period; and at the word that completes its fourth period every run is seen.

Before that, stretches are cut out by an exact sieve: in a run, each
``GRAM`` consecutive words stand again one period further on or back. Words
that belong to no gram found twice in the same stretch can't be in a run, and
a run lies in one stretch with all its neighbours that keep the period.

Tasks work text by text; memory is bounded by the longest text, at about 100
bytes for each word of a repeating stretch. ``rebuilt`` plants periods for the
query; ``runs_of`` and ``collapsed`` take texts as they are.

Defined cases: a null or empty text, or one of white space, has no words and
no run; a null doc_id is returned as null and its text is not rebuilt; repeated rows
give a row each; very long texts are treated whole; other columns are ignored
by the query and kept by ``collapsed``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import bytescan as b
from .tables import tidy

LEAST, PERIODS = 6, 4
#: Words of a gram of the sieve: the longest that stands twice in every run.
GRAM = 5
#: Passes of the sieve; more only cut stretches finer.
PASSES = 4
#: Bytes of kept words that are put together at once.
JOIN_BYTES = 4 << 20


class Automaton:
    """Suffix automaton of a sequence of word numbers (from 1 on), states numbered from 1 (the empty word)."""

    def __init__(self, words: list[int]):
        size = 2 * len(words) + 2
        self.length, self.link = array("i", bytes(4 * size)), array("i", bytes(4 * size))
        #: Most states have one transition; the others' further ones are in ``more``.
        self.word, self.to = array("i", bytes(4 * size)), array("i", bytes(4 * size))
        self.more: dict[int, dict[int, int]] = {}
        self.states = 1
        self.prefix = array("i")
        last = 1
        for w in words:
            last = self._append(w, last)
            self.prefix.append(last)

    def _append(self, w: int, last: int) -> int:
        length, link, word, to, more = self.length, self.link, self.word, self.to, self.more
        new = self.states = self.states + 1
        length[new] = length[last] + 1
        p, q = last, 0
        while p:
            if word[p] == w:
                q = to[p]
                break
            if not word[p]:
                word[p], to[p] = w, new
            else:
                rest = more.get(p)
                if rest is None:
                    more[p] = {w: new}
                elif (q := rest.get(w, 0)):
                    break
                else:
                    rest[w] = new
            p = link[p]
        if not q:
            link[new] = 1
        elif length[q] == length[p] + 1:
            link[new] = q
        else:
            twin = self.states = self.states + 1
            length[twin], link[twin] = length[p] + 1, link[q]
            word[twin], to[twin] = word[q], to[q]
            if q in more:
                more[twin] = dict(more[q])
            while p:
                if word[p] == w:
                    if to[p] != q:
                        break
                    to[p] = twin
                else:
                    rest = more.get(p)
                    if rest is None or rest.get(w) != q:
                        break
                    rest[w] = twin
                p = link[p]
            link[q] = link[new] = twin
        return new


class Paths:
    """The link tree as preferred paths in splay trees; a path's colour is held at its splay root."""

    def __init__(self, tree: Automaton):
        n = tree.states + 1
        self.length = tree.length
        self.up = array("i", tree.link[:n])
        self.above, self.below = array("i", bytes(4 * n)), array("i", bytes(4 * n))
        self.colour = array("i", b"\xff" * (4 * n))

    def splay(self, x: int) -> int:
        """Make ``x`` the root of its path's splay tree; returns the path's colour."""
        up, above, below = self.up, self.above, self.below
        while True:
            y = up[x]
            if not y or (above[y] != x and below[y] != x):
                return self.colour[x]
            z = up[y]
            if z and (above[z] == y or below[z] == y):
                self._rotate(y if (above[y] == x) == (above[z] == y) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, above, below = self.up, self.above, self.below
        y = up[x]
        z = up[y]
        if above[y] == x:
            child = above[y] = below[x]
            below[x] = y
        else:
            child = below[y] = above[x]
            above[x] = y
        if child:
            up[child] = y
        if z:
            if above[z] == y:
                above[z] = x
            elif below[z] == y:
                below[z] = x
            else:  # y was the root of its splay tree
                self.colour[x] = self.colour[y]
        else:
            self.colour[x] = self.colour[y]
        up[x], up[y] = z, x

    def access(self, x: int, now: int) -> list[tuple[int, int]]:
        """Recolour the path from ``x`` to the root; (previous end, greatest length) of each segment seen before."""
        met, down = [], 0
        up, below, colour = self.up, self.below, self.colour
        while x:
            before = self.splay(x)
            if before >= 0:
                met.append((before, self.length[x]))
            if below[x]:
                colour[below[x]] = before
            below[x] = down
            down, x = x, up[x]
        colour[down] = now
        return met


def repeats(words: list[int], least: int = LEAST, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run of a sequence of word numbers (from 1 on), by start and period."""
    tree = Automaton(words)
    paths, n = Paths(tree), len(words)
    tree.more = {}
    reach: dict[int, int] = {}  # by period: where the last run found ends
    found = []
    for i, state in enumerate(tree.prefix):
        for before, longest in paths.access(state, i):
            q = i - before
            if longest < (periods - 1) * q or longest < least - q or reach.get(q, 0) > i:
                continue
            start, end = i - longest - q + 1, i + 1
            while start and words[start - 1] == words[start - 1 + q]:
                start -= 1
            while end < n and words[end] == words[end - q]:
                end += 1
            reach[q] = end
            found.append((start, end - start, q))
    return sorted(found, key=lambda run: (run[0], run[2]))


def stretches(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of words that may hold runs; rows are ``bounds[k]:bounds[k + 1]``."""
    grams = b.Spans(codes).every(GRAM)
    if not len(grams):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(row[:len(grams)] == row[GRAM - 1:])
    part = row[at]
    for _ in range(PASSES):
        key = b.mix(grams[at] ^ b.mix(part.astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(at), bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        kept, old = at[twice], part[twice]
        if not len(kept):
            return kept, kept
        new = np.ones(len(kept), bool)
        new[1:] = (np.diff(kept) > 1) | (old[1:] != old[:-1])
        few = len(kept) == len(at)
        at, part = kept, np.cumsum(new)
        if few:
            break
    new = np.ones(len(at), bool)
    new[1:] = part[1:] != part[:-1]
    starts = at[new]
    ends = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] + GRAM
    long = ends - starts >= LEAST
    return starts[long], ends[long]


def rebuilt(n: int, doc_id: int | None) -> np.ndarray | None:
    """The place of each word in the original text of ``n`` words, or None where the text stays."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


class Texts:
    """Words of some texts in one buffer, and the runs of each text."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, doc_ids: list | None):
        rows = len(offsets) - 1
        sizes = np.diff(offsets)
        part = np.full(int(sizes.sum()) + rows, 0x20, np.uint8)  # a blank after each text keeps rows apart
        lo = offsets[0]
        for k in range(rows):
            part[offsets[k] - lo + k:offsets[k + 1] - lo + k] = buf[offsets[k]:offsets[k + 1]]
        self.starts, self.ends = b.words_of(part)
        part[self.ends] = 0x20
        self.buf = part
        self.bounds = np.searchsorted(self.starts, offsets - lo + np.arange(rows + 1))
        #: The word that stands at each place.
        self.order = np.arange(len(self.starts))
        for k in range(rows if doc_ids is not None else 0):
            x, y = self.bounds[k], self.bounds[k + 1]
            places = rebuilt(int(y - x), doc_ids[k])
            if places is not None:
                self.order[x:y] = x + places
        self.runs: list[list[tuple[int, int, int]]] = [[] for _ in range(rows)]
        self.kept = np.ones(len(self.order), bool)
        codes = b.slice_hashes(part, self.starts, self.ends)[self.order]
        for x, y in zip(*stretches(codes, self.bounds)):
            k = int(np.searchsorted(self.bounds, x, "right")) - 1
            base = int(x - self.bounds[k])
            for start, length, q in repeats(self._numbers(x, y)):
                self.runs[k].append((base + start, length, q))
                self.kept[x + start + q:x + start + length] = False
        for runs in self.runs:
            runs.sort(key=lambda run: (run[0], run[2]))

    def _numbers(self, x: int, y: int) -> list[int]:
        """The words at places x to y as numbers from 1 on; equal words, and no others, have equal numbers."""
        known: dict[bytes, int] = {}
        order = self.order[x:y]
        text = self.buf.data
        words = zip(self.starts[order].tolist(), self.ends[order].tolist())
        return [known.setdefault(bytes(text[s:e]), len(known) + 1) for s, e in words]

    def collapsed(self, k: int) -> Iterator[bytes]:
        """The kept words of text ``k``, each followed by a blank, in bounded pieces."""
        x, y = int(self.bounds[k]), int(self.bounds[k + 1])
        order = self.order[x:y][self.kept[x:y]]
        lengths = self.ends[order] - self.starts[order] + 1
        sums = np.cumsum(lengths)
        i = 0
        while i < len(order):
            j = max(i + 1, int(np.searchsorted(sums, (sums[i - 1] if i else 0) + JOIN_BYTES, "right")))
            yield b.gathered(self.buf, self.starts[order[i:j]], lengths[i:j]).tobytes()
            i = j


def texts_of(batch: pa.RecordBatch, planted: bool) -> Iterator[tuple[int, Texts]]:
    """(first row, texts) of bounded groups of rows, or of one longer row."""
    buf, offsets = b.binary_parts(batch.column("text"))
    ids = batch.column("doc_id").to_pylist() if planted else None
    for i, j in b.groups_of_rows(offsets):
        yield i, Texts(buf, offsets[i:j + 1], ids[i:j] if planted else None)


def _digested(runs: list[tuple[int, int, int]], pieces: Iterator[bytes]) -> tuple:
    """Counts, the run of the greatest exponent and the digests of one text."""
    best = None
    for run in runs:  # by start and period, so the first of equal exponents stays
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    digest, end = hashlib.sha256(), b""
    for piece in pieces:
        digest.update(end + piece[:-1])
        end = b" "
    return (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), digest.hexdigest())


NAMES = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_digested(texts.runs[k], texts.collapsed(k))
                for _, texts in texts_of(batch, True) for k in range(len(texts.runs))]
        columns = list(zip(*rows)) if rows else [[]] * len(NAMES)
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, kinds))], ["doc_id", *NAMES])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, texts in texts_of(batch, False):
            listed = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in texts.runs]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            kept = [b"".join(texts.collapsed(k))[:-1].decode() for k in range(len(texts.runs))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").slice(i, len(listed)), pa.array(listed, kind), pa.array(kept, pa.string())],
                ["row", "runs", "collapsed"])


def _text():
    return F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")


def collapsed(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``), ``runs`` (start, length, period) and ``collapsed``: the text whose
    runs keep their first period, words joined by one blank."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    kept = docs.select(_text(), row)
    run = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    schema = T.StructType([kept.schema["row"], T.StructField("runs", T.ArrayType(run)),
                           T.StructField("collapsed", T.StringType())])
    return kept.mapInArrow(tidy(_runs), schema)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the digests of the runs of its text, rebuilt by ``rebuilt`` first."""
    kinds = ", ".join(f"{c} {'string' if c.endswith('sha256') else 'long'}" for c in NAMES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text()).mapInArrow(
        tidy(_digests), f"doc_id long, {kinds}")

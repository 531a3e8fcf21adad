"""Document quality by a linear-chain conditional random field over lines (operator 8).

Each line of a text has features of its own (shares of kinds of characters,
length, whether it repeats) and the same of its two neighbours. A chain of
lines is labelled good or bad; line labels come from the document's. Fitting
maximises the conditional likelihood; scoring runs forward-backward over all
lines of a text and averages the lines' marginals, weighted by their length.

Fitting uses a documented sample: ``SAMPLE`` labelled documents, as many bad
as good where there are enough, chosen by the hash of doc_id, and of each all
lines. Their features are a stored table; in each round every task sums
forward-backward over its own texts, and the driver adds the sums. Chains are
weighted so that good and bad count as among all learning labels. Scoring reads
whole texts of all documents.

Defined cases: a text without lines (null, empty, white space) scores the
prior of learning labels; with nothing to learn from every score is 1; rows that
repeat a doc_id in the labels count once, bad if any says so; a null doc_id
is not held out; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import bytescan as b
from .langid import held_out
from .tables import stored, tidy

SAMPLE = 3000
#: Lines of the sample that a task fits on, and padded lines that run side by side.
PART_LINES, PADDED = 20_000, 1 << 17
ROUNDS, RATE, DECAY = 120, 0.1, 1e-3
THRESHOLD = 0.7
_KINDS = 16


def _kinds() -> np.ndarray:
    out = np.full(256, 15, np.uint8)
    out[128:] = 14
    out[[9, 11, 12, 13, 32]] = 3
    for kind, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789")):
        out[list(chars)] = kind
    for kind, chars in enumerate((b"!", b"|", b".", b",", b"?", b"<>{}[]", b"$%&*#@^~", b"/\\=_", b":;", b"'\"()-"), 4):
        out[list(chars)] = kind
    return out


_KIND = _kinds()
#: Own features of a line: kinds, doubled signs, words, word length, line length, whether the line repeats, share of
#: words like the one before, share of words that stand in the line already; then both neighbours' ones, and 1.
OWN = _KINDS + 7
FEATURES = 3 * OWN + 2


def line_features(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, line sizes, lines per text) of the texts ``buf[begin:end]``; blank lines are no lines."""
    cut = buf == 10
    first = np.zeros(len(buf) + 1, bool)
    first[begin[begin < end]] = True
    first[1:][cut] = True
    starts = np.flatnonzero(first[:-1])
    if not len(starts):
        return np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64), np.zeros(len(begin), np.int64)
    line = np.cumsum(first[:-1]) - 1
    kind = _KIND[buf].astype(np.int64)
    kind[cut] = 3
    counts = np.bincount(line * _KINDS + kind, minlength=len(starts) * _KINDS).reshape(-1, _KINDS)
    size = counts.sum(1) - counts[:, 3]  # bytes other than white space
    sign = (kind >= 4) & (kind != 14)
    double = np.zeros(len(buf), bool)
    double[1:] = sign[1:] & (buf[1:] == buf[:-1])
    doubles = np.bincount(line[double], minlength=len(starts))
    text = kind != 3
    opens = text.copy()
    opens[1:] &= ~text[:-1] | first[1:-1]
    words = np.bincount(line[opens], minlength=len(starts))
    spans = b.byte_spans(buf)
    word, stop = b.words_of(buf)
    home, value = line[word], spans(word, stop)
    like = np.zeros(len(word), bool)
    like[1:] = (value[1:] == value[:-1]) & (home[1:] == home[:-1])
    order = np.lexsort((value, home))
    old = np.zeros(len(word), bool)
    old[order[1:]] = (value[order[1:]] == value[order[:-1]]) & (home[order[1:]] == home[order[:-1]])
    alike, olds = np.bincount(home[like], minlength=len(starts)), np.bincount(home[old], minlength=len(starts))
    hashes = spans(starts + (buf[starts] == 10), np.append(starts[1:], len(buf)))
    keep = size > 0
    owner = np.searchsorted(begin, starts, "right") - 1
    counts, size, doubles, words, alike, olds, hashes, owner = (
        x[keep] for x in (counts, size, doubles, words, alike, olds, hashes, owner))
    order = np.lexsort((hashes, owner))
    again = np.zeros(len(order), bool)
    again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    n = np.maximum(size, 1)
    own = np.column_stack([np.sqrt(counts / n[:, None].astype(float)), np.sqrt(doubles / n), np.sqrt(words / n),
                           np.minimum(n / np.maximum(words, 1), 30) / 10, np.log1p(n) / 5, again,
                           alike / np.maximum(words, 1), olds / np.maximum(words, 1)])
    own[:, 3] = counts[:, 3] / n
    return with_neighbours(own, owner).astype(np.float32), size, np.bincount(owner, minlength=len(begin))


def with_neighbours(own: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """All features of lines from their own ones; ``owner`` is the text of each line."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = owner[1:] == owner[:-1]
    before[1:][same] = own[:-1][same]
    after[:-1][same] = own[1:][same]
    alone = np.ones(len(own))
    alone[1:][same] = 0
    return np.column_stack([own, before, after, alone, np.ones(len(own))])


def batch_features(batch: pa.RecordBatch):
    """Per chunk: row range, features, sizes and line counts."""
    buf, offsets = b.binary_parts(batch.column("text"))
    for i, j in b.groups_of_rows(offsets):
        lo, hi = offsets[i], offsets[j]
        yield i, j, *line_features(buf[lo:hi], offsets[i:j] - lo, offsets[i + 1:j + 1] - lo)


def _padded(x: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of all lines as (line, text), texts by falling length, and the order taken."""
    order = np.argsort(-lines, kind="stable")
    start = (np.cumsum(lines) - lines)[order]
    n = lines[order]
    at = np.arange(int(n[0]) if len(n) else 0)[:, None]
    inside = at < n[None, :]
    out = np.zeros(inside.shape)
    out[inside] = x[(start[None, :] + at)[inside]]
    return out, order


def forward_backward(state: np.ndarray, lines: np.ndarray, turn: np.ndarray, mass: np.ndarray | None = None):
    """Marginals of 'good' for every line, expected transitions (texts weighted by ``mass``), and log-partitions.

    ``state`` is the log-odds of good by line (bad scores 0); ``turn[a, b]``
    scores the step from label a to b. Texts run side by side, sorted by
    length, in log space.
    """
    s, order = _padded(state, lines)
    n = lines[order]
    steps, texts = s.shape
    alpha, beta = np.zeros((steps, texts, 2)), np.zeros((steps, texts, 2))
    width = [int(np.searchsorted(-n, -t, "left")) for t in range(steps)]  # texts with more than t lines
    if steps:
        alpha[0, :width[0], 1] = s[0, :width[0]]
    for t in range(1, steps):
        w = width[t]
        for to in (0, 1):
            alpha[t, :w, to] = np.logaddexp(alpha[t - 1, :w, 0] + turn[0, to], alpha[t - 1, :w, 1] + turn[1, to])
        alpha[t, :w, 1] += s[t, :w]
    for t in range(steps - 2, -1, -1):
        w = width[t + 1]
        ahead0, ahead1 = beta[t + 1, :w, 0], beta[t + 1, :w, 1] + s[t + 1, :w]
        for of in (0, 1):
            beta[t, :w, of] = np.logaddexp(turn[of, 0] + ahead0, turn[of, 1] + ahead1)
    total = np.zeros(texts)
    some = n > 0
    if steps:
        total[some] = np.logaddexp(alpha[0, some, 0] + beta[0, some, 0], alpha[0, some, 1] + beta[0, some, 1])
    good = np.exp(alpha[:, :, 1] + beta[:, :, 1] - total)
    moves = np.zeros((2, 2))
    mass = np.ones(texts) if mass is None else mass[order]
    for t in range(1, steps):
        w = width[t]
        for of in (0, 1):
            for to in (0, 1):
                moves[of, to] += mass[:w] @ np.exp(alpha[t - 1, :w, of] + turn[of, to] + to * s[t, :w]
                                                   + beta[t, :w, to] - total[:w])
    start = (np.cumsum(lines) - lines)[order]
    at = np.arange(steps)[:, None]
    inside = at < n[None, :]
    out = np.zeros(int(lines.sum()))
    out[(start[None, :] + at)[inside]] = good[inside]
    return out, moves, total


def slopes(x: np.ndarray, lines: np.ndarray, label: np.ndarray, mass: np.ndarray, weight: np.ndarray,
           turn: np.ndarray) -> np.ndarray:
    """Sums over whole chains: slope by line weight and label step, then the chains' mass.

    A chain counts ``mass`` over its number of lines, so long texts don't outweigh the others.
    """
    y = np.repeat(label, lines).astype(float)
    mass = mass / np.maximum(lines, 1)
    by_line = np.repeat(mass, lines)
    steps = np.zeros((2, 2))
    for k in (0, 1):
        steps[k, k] = (mass * np.maximum(lines - 1, 0))[label == k].sum()
    good, moves, _ = forward_backward(x @ weight, lines, turn, mass)
    return np.concatenate((x.T @ (by_line * (y - good)), (steps - moves).ravel(), [by_line.sum()]))


def fit(sums: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of line features and of label steps, by Adam on the conditional likelihood; ``sums`` as ``slopes``."""
    weight, turn = np.zeros(FEATURES), np.zeros((2, 2))
    mean, square = np.zeros(len(weight) + 4), np.zeros(len(weight) + 4)
    for k in range(1, ROUNDS + 1):
        got = sums(weight, turn)
        slope = got[:-1] / max(got[-1], 1e-9)
        slope -= DECAY * np.concatenate((weight, turn.ravel()))
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope ** 2
        move = RATE * (mean / (1 - 0.9 ** k)) / (np.sqrt(square / (1 - 0.99 ** k)) + 1e-8)
        weight, turn = weight + move[:-4], turn + move[-4:].reshape(2, 2)
    return weight, turn


def sampled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, float]:
    """(id, label, lines, own features) of the fitting sample, and the share of good among all learning labels."""
    known = labels.filter("quality is not null and doc_id is not null").filter(~held_out(F.col("doc_id"), 4, 2))
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").cast("int").alias("label"))
    good, n = known.agg(F.sum("label"), F.count("*")).first()
    half = sample // 2
    ids = [known.filter(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(half) for k in (0, 1)]
    # ``sample`` rows of two numbers: small by definition.
    chosen = F.broadcast(ids[0].unionAll(ids[1]))
    rows = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")).join(
        chosen, F.col("_id") == F.col("id")).select("id", "label", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy()
            for i, j, x, _, lines in batch_features(batch):
                ends = np.cumsum(lines)
                blobs = [x[e - k:e, :OWN].tobytes() for e, k in zip(ends, lines, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(i, j - i), pa.array(label[i:j], pa.int32()), pa.array(lines, pa.int32()),
                     pa.array(blobs, pa.binary())], ["id", "label", "lines", "own"])

    return rows.mapInArrow(tidy(features), "id long, label int, lines int, own binary"), (good / n if n else 1.0)


def alike_long(lines: np.ndarray) -> Iterator[np.ndarray]:
    """Places of texts by rising length, so many at once that padding them takes ``PADDED`` lines, or one longer text."""
    order = np.argsort(lines, kind="stable")
    at = 0
    while at < len(order):
        n = np.arange(1, len(order) - at + 1)
        stop = at + max(1, int(np.searchsorted(n * lines[order[at:]], PADDED, "right")))
        yield order[at:stop]
        at = stop


def summed(rows: DataFrame, masses: tuple[float, float], weight: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """``slopes`` over all of ``rows``: each task sums its own texts, the driver adds the sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, lines = (batch.column(c).to_numpy().astype(np.int64) for c in ("label", "lines"))
            for some in alike_long(lines):
                own = np.concatenate([np.frombuffer(batch.column("own")[int(i)].as_buffer(), np.float32) for i in some])
                n = lines[some]
                x = with_neighbours(own.reshape(-1, OWN), np.repeat(np.arange(len(n)), n)).astype(float)
                got = slopes(x, n, label[some], np.array(masses)[label[some]], weight, turn)
                yield pa.RecordBatch.from_arrays([pa.array([got.tolist()], pa.list_(pa.float64()))], ["sums"])

    parts = rows.mapInArrow(tidy(run), "sums array<double>").collect()
    # Exact sums: the order in which tasks end doesn't matter.
    return np.array([fsum(column) for column in zip(*(r[0] for r in parts), strict=True)])


def fitted(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Line weights, step weights and prior."""
    rows, prior = sampled(docs, labels)
    rows = stored(rows, "quality-lines")
    n, good, total = rows.agg(F.count("*"), F.sum("label"), F.sum("lines")).first()
    if not total:
        return np.zeros(FEATURES), np.zeros((2, 2)), prior
    rows = rows.filter("lines > 0").repartition(-(-total // PART_LINES), "id").sortWithinPartitions("id", "own")
    rows = stored(rows, "quality-sample")
    share = max(good / n, 1e-9)  # of good ones in the sample, against the prior
    masses = (1 - prior) / max(1 - share, 1e-9), prior / share
    return *fit(lambda weight, turn: summed(rows, masses, weight, turn)), prior


def scores(batch: pa.RecordBatch, weight: np.ndarray, turn: np.ndarray, prior: float) -> np.ndarray:
    out = np.full(batch.num_rows, prior)
    for i, j, x, size, lines in batch_features(batch):
        state, good = x @ weight, np.zeros(len(x))
        before = np.cumsum(lines) - lines
        for alike in alike_long(lines):  # one very long text does not pad the others
            n = lines[alike]
            at = np.repeat(before[alike] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            good[at] = forward_backward(state[at], n, turn)[0]
        owner = np.repeat(np.arange(j - i), lines)
        some = lines > 0
        mass = np.bincount(owner, size, j - i)
        out[i:j][some] = np.bincount(owner, size * good, j - i)[some] / mass[some]
    return np.clip(out, 0.0, 1.0)


def _applied(docs: DataFrame, labels: DataFrame, row: list[str]) -> DataFrame:
    weight, turn, prior = fitted(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(scores(batch, weight, turn, prior), pa.float64())], ["row", "score"])

    kept = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in row]).alias("row"))
    return kept.mapInArrow(tidy(run), T.StructType([kept.schema["row"], T.StructField("score", T.DoubleType())]))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each row."""
    doc_id = F.col("row.doc_id").cast("long")
    return _applied(docs, labels, ["doc_id"]).select(
        doc_id.alias("doc_id"), held_out(F.col("row.doc_id"), 4, 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score at least ``THRESHOLD``."""
    good = _applied(docs, labels, docs.columns).filter(F.col("score") >= THRESHOLD)
    return good.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])

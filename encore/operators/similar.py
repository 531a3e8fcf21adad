"""Similar tracks by cosine similarity.

Exact top-k (J4) without a cross join: vectors are hashed into ``nb`` blocks;
every unordered pair of blocks becomes one group holding the two blocks, so a
group holds about ``2 * block_rows`` vectors whatever the data, and each
vector is shuffled ``nb`` times. Inside the group numpy scores the pair in
both directions, a tile of bounded size at a time, and keeps only the k best
candidates per vector; a final top-k per track merges the ``nb`` partial
lists. Pairs are never materialised as rows, and a task's memory is its two
blocks and some tiles, however many vectors there are.

Similarities are rounded to 6 decimals (half away from zero) and ranked on
the rounded value, ties by candidate id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.score import SIMILARITY_TYPE
from encore.operators.joins import broadcast_if_bounded
from encore.sinks.files import materialize

DEFAULT_BLOCK_ROWS = 16384
#: Blocks that vectors are cut into, at least, if these hold ``LEAST_BLOCK_ROWS``: their pairs are tasks for all cores.
LEAST_BLOCKS, LEAST_BLOCK_ROWS = 8, 1024
#: Tracks whose exact neighbours tell how many bands a recall takes.
RECALL_SAMPLE = 256
#: Shuffling one vector costs about as much as scoring so many pairs.
_COPY_COST = 512
_MAX_BITS = 24
_SIGNS_AT_ONCE = 1 << 22
#: Queries and candidates of a tile: what a task holds beside its two blocks is some tiles of 2 MB.
_QUERY_CHUNK, _CAND_CHUNK = 512, 512
_NO_SCORE = -np.iinfo(np.int64).max  # its negative, used to sort, is a number too

_PARTIAL_SCHEMA = ("track_id long, similar_track_id long, sim_micro long, "
                   "similar_label int, rank int")


def _round_micro(sim: np.ndarray) -> np.ndarray:
    """Round to 6 decimals, half away from zero, as an int64 count of 1e-6."""
    scaled = sim * 1e6
    whole = np.trunc(scaled)
    frac = scaled - whole
    return (whole + np.sign(frac) * (np.abs(frac) >= 0.5)).astype(np.int64)


def _empty_partial() -> pd.DataFrame:
    return pd.DataFrame({"track_id": pd.Series([], dtype="int64"),
                         "similar_track_id": pd.Series([], dtype="int64"),
                         "sim_micro": pd.Series([], dtype="int64"),
                         "similar_label": pd.Series([], dtype="int32"),
                         "rank": pd.Series([], dtype="int32")})


def _block(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids (ascending), labels, vectors and their norms."""
    rows = rows.sort_values("track_id")
    mat = np.stack(rows["features"].to_numpy()).astype(np.float64, copy=False)
    return rows["track_id"].to_numpy(np.int64), rows["label"].to_numpy(), mat, np.linalg.norm(mat, axis=1)


def _chunks(n: int, size: int) -> list[slice]:
    return [slice(at, min(at + size, n)) for at in range(0, n, size)]


def _tile(qmat: np.ndarray, q_norm: np.ndarray, cmat: np.ndarray,
          c_norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rounded similarities of a tile of queries and candidates, and which are defined."""
    den = np.outer(q_norm, c_norm)
    with np.errstate(divide="ignore", invalid="ignore"):
        sim = (qmat @ cmat.T) / den
    valid = np.isfinite(sim) & (den > 0)
    return _round_micro(np.where(valid, sim, 0.0)), valid


def _best(best: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest keys of each row of both."""
    both = np.concatenate([best, key], axis=1)
    return both if both.shape[1] <= k else np.partition(both, both.shape[1] - k, axis=1)[:, -k:].copy()


def _similarities(qmat: np.ndarray, q_norm: np.ndarray, cmat: np.ndarray, c_norm: np.ndarray,
                  room: np.ndarray) -> np.ndarray:
    """A tile of similarities in ``room``, not rounded; not finite where they are not defined."""
    sim, den = room[:, :len(qmat), :len(cmat)]
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        np.matmul(qmat, cmat.T, out=sim)
        np.multiply(q_norm[:, None], c_norm, out=den)
        sim /= den
    return sim


def _room() -> np.ndarray:
    return np.empty((2, _QUERY_CHUNK, _CAND_CHUNK))


def _reaching(sim: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and rounded similarities of the defined pairs of a tile at or above their row's floor.

    Rows without a floor take two millionths below their k-th similarity here: what is less rounds to less.
    """
    if k < sim.shape[1] and np.isneginf(floor).any():
        defined = np.where(np.isfinite(sim), sim, -np.inf)
        floor = np.maximum(floor, np.partition(defined, sim.shape[1] - k, axis=1)[:, -k] - 2e-6)
    rows, columns = np.divmod(np.flatnonzero(sim >= floor[:, None]), sim.shape[1])
    value = sim[rows, columns]
    defined = np.isfinite(value)
    return rows[defined], columns[defined], _round_micro(value[defined])


def _enter(best: np.ndarray, floor: np.ndarray, rows: np.ndarray, keys: np.ndarray, n_cands: int) -> None:
    """Take keys, in order of their rows, into the largest of these rows.

    A row's floor is a millionth below its last similarity, so that no
    candidate that rounds to it is left out; none while it has fewer.
    """
    if not len(rows):
        return
    own, first, n = np.unique(rows, return_index=True, return_counts=True)
    new = np.full((len(own), n.max()), _NO_SCORE, np.int64)
    new[np.repeat(np.arange(len(own)), n), np.arange(len(rows)) - np.repeat(first, n)] = keys
    best[own] = _best(best[own], new, best.shape[1])
    least = best[own].min(axis=1)
    floor[own] = np.where(least == _NO_SCORE, -np.inf, (least // n_cands - 1) * 1e-6)


def _no_lists(n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and floors of rows without a candidate yet."""
    return np.full((n, k), _NO_SCORE, np.int64), np.full(n, -np.inf)


def _lists(ids: np.ndarray, best: np.ndarray, c_ids: np.ndarray, c_lab: np.ndarray) -> pd.DataFrame:
    """Each row's keys as ranked candidates; a key is micro * len(c_ids) + len(c_ids) - 1 - position:
    similarity first, then the smaller candidate id."""
    best = -np.sort(-best, axis=1)
    rows, places = np.nonzero(best != _NO_SCORE)
    keys = best[rows, places]
    at = len(c_ids) - 1 - keys % len(c_ids)
    return pd.DataFrame({"track_id": ids[rows], "similar_track_id": c_ids[at], "sim_micro": keys // len(c_ids),
                         "similar_label": c_lab[at], "rank": (places + 1).astype(np.int32)})


def _score(queries: pd.DataFrame, cands: pd.DataFrame, k: int,
           include_self: bool) -> list[pd.DataFrame]:
    """The k best candidates of every query row (one direction of a block pair), scored tile by tile."""
    c_ids, c_lab, cmat, c_norm = _block(cands)
    q_ids, _, qmat, q_norm = _block(queries)
    mc = len(c_ids)
    tie = mc - 1 - np.arange(mc, dtype=np.int64)
    out, room = [], _room()
    for q in _chunks(len(q_ids), _QUERY_CHUNK):
        best, floor = _no_lists(q.stop - q.start, min(k, mc))
        for c in _chunks(mc, _CAND_CHUNK):
            sim = _similarities(qmat[q], q_norm[q], cmat[c], c_norm[c], room)
            if not include_self:
                sim[q_ids[q, None] == c_ids[None, c]] = -np.inf
            rows, columns, micro = _reaching(sim, floor, k)
            _enter(best, floor, rows, micro * mc + tie[c][columns], mc)
        out.append(_lists(q_ids[q], best, c_ids, c_lab))
    return out


def _score_both(first: pd.DataFrame, second: pd.DataFrame, k: int) -> list[pd.DataFrame]:
    """Two disjoint blocks scored against each other, every pair once.

    Each tile of similarities updates the running top-k of its rows
    (first -> second) and of its columns (second -> first). Only pairs that
    reach a list's last similarity so far are rounded and ranked.
    """
    a_ids, a_lab, amat, a_norm = _block(first)
    b_ids, b_lab, bmat, b_norm = _block(second)
    ma, mb = len(a_ids), len(b_ids)
    tie_a, tie_b = (m - 1 - np.arange(m, dtype=np.int64) for m in (ma, mb))
    best_b, floor_b = _no_lists(mb, min(k, ma))
    out, room = [], _room()
    for r in _chunks(ma, _QUERY_CHUNK):
        best_a, floor_a = _no_lists(r.stop - r.start, min(k, mb))
        for c in _chunks(mb, _CAND_CHUNK):
            sim = _similarities(amat[r], a_norm[r], bmat[c], b_norm[c], room)
            rows, columns, micro = _reaching(sim, floor_a, k)
            _enter(best_a, floor_a, rows, micro * mb + tie_b[c][columns], mb)
            rows, columns, micro = _reaching(sim.T, floor_b[c], k)
            _enter(best_b[c], floor_b[c], rows, micro * ma + tie_a[r][columns], ma)
        out.append(_lists(a_ids[r], best_a, b_ids, b_lab))
    out += [_lists(b_ids[c], best_b[c], a_ids, a_lab) for c in _chunks(mb, _CAND_CHUNK)]
    return out


def _pair_top_k(k: int, include_self: bool):
    """Score one unordered block pair in both directions (a block with itself once)."""
    def score_pair(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf[pdf["side"] == 0]
        second = pdf[pdf["side"] == 1]
        if first.empty:
            return _empty_partial()
        if second.empty:
            parts = _score(first, first, k, include_self)
        else:  # disjoint blocks: no self pairs
            parts = _score_both(first, second, k)
        return pd.concat(parts, ignore_index=True) if parts else _empty_partial()
    return score_pair


def one_vector_per_track(vectors: DataFrame) -> DataFrame:
    """(track_id, features ARRAY<DOUBLE>, label), one row per track.

    Copies of a track collapse map-side (partial aggregation), so a track
    repeated in a third of the rows cannot inflate a block; the kept vector
    is the largest (features, label), which is deterministic. Trained item
    factors carry no label; theirs is NULL.
    """
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    clean = (vectors.select(F.col("track_id").cast("bigint").alias("track_id"),
                            F.col("features").cast("array<double>").alias("features"),
                            label.alias("label"))
             .filter(F.col("features").isNotNull() & (F.size("features") > 0)))
    return (clean.groupBy("track_id").agg(F.max(F.struct("features", "label")).alias("v"))
            .select("track_id", "v.features", "v.label"))


def _pair_layout(placed: DataFrame, nb, keys: list[str]) -> DataFrame:
    """Send each vector of block b to the unordered pairs (min(b, x), max(b, x)).

    Every vector is copied nb times (not 2 nb), and there are nb (nb + 1) / 2
    groups of at most two blocks each.
    """
    x = placed.select(*keys, "blk", F.explode(F.sequence(F.lit(0), nb - 1)).alias("x"),
                      "track_id", "features", "label")
    lo, hi = F.least("blk", "x"), F.greatest("blk", "x")
    return x.select(*keys, lo.alias("lo"), hi.alias("hi"),
                    F.when(F.col("blk") == lo, 0).otherwise(1).alias("side"),
                    "track_id", "features", "label")


def block_rows_for(n_vectors: int) -> int:
    """Rows of a block: ``DEFAULT_BLOCK_ROWS``, fewer where that would leave cores without work."""
    return max(LEAST_BLOCK_ROWS, min(DEFAULT_BLOCK_ROWS, math.ceil(n_vectors / LEAST_BLOCKS)))


def similar_tracks(vectors: DataFrame, k: int = 10, n_vectors: int | None = None,
                   block_rows: int | None = None,
                   include_self: bool = False) -> DataFrame:
    """Exact k most similar tracks per track.

    ``vectors``: (track_id BIGINT, features ARRAY<DOUBLE>, label INT).
    Returns (track_id, rank, similar_track_id, similarity DECIMAL(8,6), similar_label).
    """
    if n_vectors is None:
        n_vectors = vectors.count()
    nb = max(1, math.ceil(n_vectors / (block_rows or block_rows_for(n_vectors))))
    base = (one_vector_per_track(vectors)
            .withColumn("blk", F.pmod(F.xxhash64("track_id"), F.lit(nb)).cast("int")))
    partial = (_pair_layout(base, F.lit(nb), [])
               .groupBy("lo", "hi")
               .applyInPandas(_pair_top_k(k, include_self), _PARTIAL_SCHEMA))
    if nb > 1:
        # each track has nb partial lists (one per block it was scored against)
        w = Window.partitionBy("track_id").orderBy(F.col("sim_micro").desc(),
                                                   F.col("similar_track_id").asc())
        partial = (partial.withColumn("rank", F.row_number().over(w))
                   .filter(F.col("rank") <= k))
    return (partial
            .select("track_id", "rank", "similar_track_id",
                    (F.col("sim_micro").cast("decimal(14,0)") / F.lit(1_000_000))
                    .cast(SIMILARITY_TYPE).alias("similarity"),
                    "similar_label"))


def _ranked(lists: DataFrame, k: int) -> DataFrame:
    """Scored candidates -> each track's ``k`` best, in the columns of ``similar_tracks``."""
    w = Window.partitionBy("track_id").orderBy(F.col("sim_micro").desc(),
                                               F.col("similar_track_id").asc())
    return (lists.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .select("track_id", "rank", "similar_track_id",
                    (F.col("sim_micro").cast("decimal(14,0)") / F.lit(1_000_000))
                    .cast(SIMILARITY_TYPE).alias("similarity"),
                    "similar_label"))


def nearest_of(queries: DataFrame, vectors: DataFrame, k: int = 10,
               n_queries: int | None = None, n_vectors: int | None = None,
               block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Exact k most similar tracks of the query tracks alone, searched in all vectors.

    Both sides are cut into blocks; a group holds one block of each. Each
    vector is shuffled once per block of queries, each query once per block
    of vectors. A track is no neighbour of itself, also where its two vectors
    differ. Same columns as ``similar_tracks``.
    """
    n_queries = queries.count() if n_queries is None else n_queries
    n_vectors = vectors.count() if n_vectors is None else n_vectors
    q_blocks, v_blocks = (max(1, math.ceil(n / block_rows)) for n in (n_queries, n_vectors))

    def placed(df, side, own, n_own, other, n_other):
        return one_vector_per_track(df).select(
            F.pmod(F.xxhash64("track_id"), F.lit(n_own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other),
            F.lit(side).alias("side"), "track_id", "features", "label")

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        asked, found = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        if asked.empty or found.empty:
            return _empty_partial()
        return pd.concat(_score(asked, found, k, False), ignore_index=True)

    both = (placed(queries, 0, "qb", q_blocks, "vb", v_blocks)
            .unionByName(placed(vectors, 1, "vb", v_blocks, "qb", q_blocks)))
    return _ranked(both.groupBy("qb", "vb").applyInPandas(score, _PARTIAL_SCHEMA), k)


def _hyperplane_codes(dim: int, n_bands: int, bits: int, seed: int):
    planes = np.random.default_rng(seed).standard_normal((n_bands * bits, dim))
    weights = (1 << np.arange(bits)).astype(np.int64)
    step = max(1, _SIGNS_AT_ONCE // len(planes))

    def run(batches):
        for pdf in batches:
            for start in range(0, len(pdf), step):
                rows = pdf.iloc[start:start + step]
                x = np.stack(rows["features"].to_numpy()).astype(np.float64)
                signs = (x @ planes.T >= 0).reshape(len(x), n_bands, bits)
                yield pd.DataFrame({
                    "track_id": np.repeat(rows["track_id"].to_numpy(np.int64), n_bands),
                    "band": np.tile(np.arange(n_bands, dtype=np.int32), len(x)),
                    "bucket": (signs @ weights).ravel().astype(np.int64),
                })
    return run


def bands_for_recall(similarities: np.ndarray, bits: int, target_recall: float) -> int:
    """Fewest bands of ``bits`` sign bits in which pairs of these cosines meet, on
    average, with probability ``target_recall``: two vectors at angle t share a
    sign with probability 1 - t / pi."""
    same = (1.0 - np.arccos(np.clip(similarities, -1.0, 1.0)) / np.pi) ** bits
    reached = lambda n: np.mean(1.0 - (1.0 - same) ** n) >= target_recall
    high = 1
    while not reached(high):
        high *= 2
        if high > 1 << 20:
            raise ValueError(f"no number of bands of {bits} bits finds {target_recall} of the lists")
    low = high // 2
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if reached(middle) else (middle, high)
    return high


def _lsh_shape(similarities: np.ndarray, n_vectors: int, bits: int | None,
               target_recall: float) -> tuple[int, int]:
    """(bands, bits): the given ``bits``, or those with the least copies and scored pairs."""
    shapes = []
    for b in range(1, _MAX_BITS + 1) if bits is None else [bits]:
        bands = bands_for_recall(similarities, b, target_recall)
        shapes.append((bands * (_COPY_COST + n_vectors / 2 ** b), bands, b))
        if bands * _COPY_COST > shapes[0][0]:
            break  # more bits only take more bands
    return min(shapes)[1:]


def similar_tracks_lsh(vectors: DataFrame, k: int = 10, n_bands: int | None = None,
                       bits: int | None = None, seed: int = 7, target_recall: float = 0.9,
                       block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Approximate k most similar tracks with random-hyperplane LSH.

    A track's candidates are the tracks sharing a bucket with it in at least
    one of ``n_bands`` bands of ``bits`` sign bits. Each bucket is scored with
    the same bounded block pairs as the exact form (a hot bucket is split into
    blocks, never expanded into pairs); the best score per pair over bands is
    kept and cut to ``k`` per track. Same output as ``similar_tracks``.

    Bands follow from the bits and ``target_recall``: the exact neighbours of
    ``RECALL_SAMPLE`` tracks (by hash of the id) tell how alike neighbours
    are. Bits left open are those that copy and score least. Tracks whose
    buckets gave fewer than ``k`` candidates are searched in all vectors, so
    every list is as long as the exact one.
    """
    spark = vectors.sparkSession
    vec = materialize(spark, one_vector_per_track(vectors), "lsh_vectors")
    n_vectors = vec.count()  # from the footers
    if n_vectors == 0:
        return similar_tracks(vec, k, 0, block_rows)
    if n_bands is None or bits is None:
        sample = vec.orderBy(F.xxhash64("track_id"), "track_id").limit(RECALL_SAMPLE)
        near = nearest_of(sample, vec, k, RECALL_SAMPLE, n_vectors, block_rows)
        # at most RECALL_SAMPLE * k numbers
        cosines = near.select(F.col("similarity").cast("double")).toPandas()["similarity"].to_numpy()
        if len(cosines) == 0:  # no two vectors with a direction
            return similar_tracks(vec, k, n_vectors, block_rows)
        found, bits = _lsh_shape(cosines, n_vectors, bits, target_recall)
        n_bands = found if n_bands is None else n_bands
    dim = len(vec.select("features").first()[0])
    codes = vec.select("track_id", "features").mapInPandas(
        _hyperplane_codes(dim, n_bands, bits, seed), "track_id long, band int, bucket long")
    # a track alone in its bucket meets nobody there
    sizes = (codes.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("size"))
             .filter(F.col("size") > 1)
             .select("band", "bucket",
                     F.ceil(F.col("size") / block_rows).cast("int").alias("nb")))
    bound = n_bands * min(2 ** bits, n_vectors // 2)
    placed = (codes.join(broadcast_if_bounded(sizes, bound), ["band", "bucket"])
              .join(vec, "track_id")
              .withColumn("blk", F.pmod(F.xxhash64("track_id"), F.col("nb")).cast("int")))
    partial = (_pair_layout(placed, F.col("nb"), ["band", "bucket"])
               .groupBy("band", "bucket", "lo", "hi")
               .applyInPandas(_pair_top_k(k, False), _PARTIAL_SCHEMA))
    best = (partial.groupBy("track_id", "similar_track_id")
            .agg(F.max("sim_micro").alias("sim_micro"),
                 F.max("similar_label").alias("similar_label")))
    lists = materialize(spark, _ranked(best, k), "lsh_lists")
    full = lists.filter(F.col("rank") == k).select("track_id")
    short = vec.join(full, "track_id", "left_anti")
    return (lists.join(full, "track_id", "left_semi")
            .unionByName(nearest_of(short, vec, k, None, n_vectors, block_rows)))


def recall_at_k(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact (track, similar track) pairs the approximate table found."""
    hit = exact.select("track_id", "similar_track_id").join(
        approx.select("track_id", "similar_track_id", F.lit(1).alias("found")),
        ["track_id", "similar_track_id"], "left")
    return hit.agg((F.sum(F.coalesce("found", F.lit(0))) / F.count(F.lit(1))).alias("recall"))

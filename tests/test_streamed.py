"""Candidates in a stream against blocks of queries: the lists of doubles, ties, copies, odd norms; few copies shuffled."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from encore.operators import cells, streamed
from encore.operators.similar import _round_micro


def batch(grp, side, ids, mat, cell=None, bits=None, label=None):
    n, d = mat.shape
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, grp, np.int32)), pa.array(np.full(n, side, np.int32)),
         pa.array(np.zeros(n, np.int32) if cell is None else cell.astype(np.int32)),
         pa.nulls(n, pa.binary()) if bits is None else pa.array(bits, pa.binary()), pa.array(ids.astype(np.int64)),
         pa.ListArray.from_arrays(pa.array(np.arange(0, n * d + 1, d), pa.int32()), pa.array(mat.ravel())),
         pa.array([None] * n if label is None else label, pa.int32())],
        ["grp", "side", "cell", "bits", "track_id", "features", "label"])


def brute(q_ids, q, c_ids, c, k, meets=None):
    """(query, candidate, micro) of the k best, in doubles."""
    out = set()
    for i, (qi, x) in enumerate(zip(q_ids, q)):
        best = {}
        for j, (cj, y) in enumerate(zip(c_ids, c)):
            with np.errstate(all="ignore"):
                den = np.linalg.norm(x) * np.linalg.norm(y)
                sim = (x * y).sum() / den
            if qi != cj and den > 0 and np.isfinite(sim) and (meets is None or meets[i, j]):
                best[int(cj)] = int(_round_micro(np.array([sim]))[0])
        out |= {(int(qi), cj, m) for cj, m in sorted(best.items(), key=lambda e: (-e[1], e[0]))[:k]}
    return out


def got(batches, k):
    return [tuple(r.values())[:3] for b in streamed.streamed_lists(k)(iter(batches)) for r in b.to_pylist()]


@pytest.mark.parametrize("kind", ["plain", "floats", "copies", "alike", "huge and tiny"])
def test_lists_are_those_of_doubles(kind, monkeypatch):
    monkeypatch.setattr(streamed, "_CANDS", 7)
    monkeypatch.setattr(streamed, "_TILE", 50)
    monkeypatch.setattr(streamed, "_PAIRS", 16)
    rng = np.random.default_rng(4)
    c = rng.normal(size=(90, 5))
    if kind == "floats":
        c = c.astype(np.float32)
    if kind == "copies":
        c = c[rng.integers(0, 6, 90)]
    if kind == "alike":  # differ by less than single precision tells
        c = 1.0 + rng.integers(0, 40, (90, 5)) * 1e-6
    if kind == "huge and tiny":
        c[::3] *= 1e160
        c[1::3] *= 1e-160
    ids = rng.permutation(200)[:90]
    q = np.argsort(ids[:40])
    order = rng.permutation(90)
    rows = [batch(3, 0, ids[q][:25], c[q][:25]), batch(3, 0, ids[q][25:], c[q][25:]), batch(3, 1, ids[order][:50], c[order][:50]),
            batch(3, 1, ids[order][50:], c[order][50:]), batch(5, 1, ids, c), batch(6, 0, ids[q], c[q]), batch(7, 0, ids[q], c[q]),
            batch(7, 1, ids[order], c[order])]
    for k in (1, 4, 100):
        found = got(rows, k)
        expected = brute(ids[q], c[q].astype(float), ids, c.astype(float), k)
        assert len(found) == 2 * len(expected) and set(found) == expected


def test_a_candidate_in_several_asked_cells_is_listed_once(monkeypatch):
    monkeypatch.setattr(streamed, "_CANDS", 4)
    rng = np.random.default_rng(5)
    c, ids = rng.normal(size=(30, 4)), np.arange(100, 130)
    asks = rng.random((30, 12)) < 0.4
    stands = np.array([rng.permutation(12)[:3] for _ in ids])
    bits = [np.packbits(a, bitorder="little").tobytes() for a in asks]
    cell = stands.ravel()
    order = np.argsort(cell, kind="stable")
    held = np.repeat(ids, 3)[order], np.repeat(c, 3, axis=0)[order]
    found = got([batch(0, 0, ids, c, bits=bits), batch(0, 1, *held, cell=cell[order])], 5)
    meets = np.array([[asks[i, s].any() for s in stands] for i in range(30)])
    assert len(found) == len(set(found)) and set(found) == brute(ids, c, ids, c, 5, meets)


def test_vectors_of_other_lengths_are_refused():
    one, two = np.ones((2, 3)), np.ones((2, 4))
    with pytest.raises(ValueError):
        got([batch(0, 0, np.arange(2), one), batch(0, 1, np.arange(2), two)], 2)


def test_blocks_asked_as_bits_are_those_asked_as_cells():
    rng = np.random.default_rng(6)
    centroids = np.eye(9)
    first, several = cells.dealt(np.array([3, 4, 2, 25, 1, 0, 9, 1, 1]), 10)
    low, held = np.array([0, 3, 3, 3, 4, 7]), np.array([3, 1, 1, 1, 3, 2])
    rows = pa.RecordBatch.from_pydict({"track_id": list(range(20)), "features": rng.normal(size=(20, 9)).tolist(),
                                       "label": [1] * 20})
    assert (first + several).max() <= len(low)
    plain, = cells.asking(centroids, 4, first, several)([rows])
    blocks = [[b["vb"] for b in a] for a in plain.column("asked").to_pylist()]
    low, held = low[:(first + several).max()], held[:(first + several).max()]
    out, = cells.packed(cells.asking(centroids, 4, first, several), low, held)([rows])
    for a, b, mine in zip(plain.column("asked").to_pylist(), out.column("asked").to_pylist(), blocks):
        assert [x["vb"] for x in b] == mine
        for x, y in zip(a, b):
            bits = np.unpackbits(np.frombuffer(y["bits"], np.uint8), bitorder="little")
            assert (low[y["vb"]] + np.flatnonzero(bits)).tolist() == x["cells"]
    union, = cells.cells_of(low, 9)([out])
    assert union.column("c").to_pylist() == sorted({c for a in plain.column("asked").to_pylist() for x in a for c in x["cells"]})


def test_nearest_cells_are_those_of_a_full_sort():
    rng = np.random.default_rng(7)
    centroids = rng.integers(-1, 2, (40, 3)).astype(float)  # many as near as others
    centroids /= np.maximum(1e-9, np.linalg.norm(centroids, axis=1, keepdims=True))
    x = rng.normal(size=(50, 3))
    near = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ centroids.T
    for n in (1, 3, 8, 39, 40):
        assert (cells._nearest(x, centroids, n) == np.argsort(-near, axis=1, kind="stable")[:, :n]).all()


def test_few_copies_travel_however_many_vectors():
    n = 615_384  # as many as 6 GB have; blocks of 16,384 took 76 copies of a vector, and 226 with three stored copies
    for rows in (n, 3 * n):
        q, v = cells.blocks_for(n, rows, streamed.QUERY_BYTES // (8 * 64), 6)
        assert q * v >= 24
        assert v * n + q * rows <= 25 * n
    assert cells.blocks_for(10, 10, 1000, 6) == (1, 1)
    q, v = cells.blocks_for(2_000, 6_000, 1000, 6)
    assert q >= 2 and v <= 6


def test_pairs_of_blocks_fill_the_cores():
    for cores in (4, 6, 8, 12):
        q, v = cells.blocks_for(615_384, 615_384, streamed.QUERY_BYTES // (8 * 64), cores)
        waves = -(-q * v // cores)
        assert q * v / (waves * cores) >= 0.9, (cores, q, v)


def test_vectors_travel_in_the_type_that_holds_them(spark):
    floats = spark.createDataFrame([(1, [0.5, -0.25]), (2, [1.0, 3.0])], "track_id long, features array<double>")
    doubles = floats.withColumn("features", F.transform("features", lambda x: x + 1e-12))
    assert cells.narrowest(floats, floats.limit(0)) == "array<float>"
    assert cells.narrowest(floats, doubles) == "array<double>"

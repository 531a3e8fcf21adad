"""Exact blocked top-k against numpy brute force; LSH recall against exact."""

import numpy as np
import pytest

from tests.conftest import SF_MID, SF_SMALL
from encore.operators.similar import (nearest_of, recall_at_k, similar_tracks,
                                      similar_tracks_lsh)
from encore.sources import testdata as td


def brute_force(pdf, k):
    ids = pdf.track_id.to_numpy()
    x = np.stack(pdf.features.to_numpy())
    n = np.linalg.norm(x, axis=1)
    sim = (x @ x.T) / np.outer(n, n)
    out = {}
    for i, t in enumerate(ids):
        cand = [(-round(sim[i, j] * 1e6), ids[j]) for j in range(len(ids)) if ids[j] != t]
        out[t] = [c[1] for c in sorted(cand)[:k]]
    return out


@pytest.mark.parametrize("block_rows", [4096, 64, 100])
def test_blocked_exact_matches_brute_force(spark, block_rows):
    vec = td.vectors(spark, SF_SMALL)
    got = similar_tracks(vec, k=10, block_rows=block_rows).toPandas()
    want = brute_force(vec.toPandas(), 10)
    for t, grp in got.groupby("track_id"):
        assert list(grp.sort_values("rank").similar_track_id) == want[t]
    assert len(got) == 10 * len(want)


@pytest.mark.parametrize("bits", [None, 2, 6])
def test_lsh_recall_and_full_lists(spark, bits):
    vec = td.vectors(spark, SF_MID)
    exact = similar_tracks(vec, k=10).cache()
    approx = similar_tracks_lsh(vec, k=10, bits=bits).cache()
    assert recall_at_k(approx, exact).collect()[0].recall >= 0.8
    assert approx.count() == exact.count()


def test_lsh_completes_short_lists(spark):
    vec = td.vectors(spark, SF_SMALL)
    exact = similar_tracks(vec, k=10)
    # one band of many bits: nearly every track is alone in its bucket
    approx = similar_tracks_lsh(vec, k=10, n_bands=1, bits=20)
    assert recall_at_k(approx, exact).collect()[0].recall == 1.0
    assert approx.count() == exact.count()


def test_lsh_of_few_or_no_vectors(spark):
    schema = "track_id long, features array<double>, label int"
    rows = [(1, [1.0, 0.0], 1), (2, [0.0, 1.0], 2), (3, [0.0, 0.0], 3), (4, None, 4)]
    for own in (rows, rows[2:], []):
        vec = spark.createDataFrame(own, schema)
        assert sorted(similar_tracks_lsh(vec).collect()) == sorted(similar_tracks(vec).collect())


def test_nearest_of_equals_the_exact_lists(spark):
    vec = td.vectors(spark, SF_SMALL)
    asked = vec.filter("track_id % 7 = 0")
    got = nearest_of(asked, vec, k=10, block_rows=30)
    want = similar_tracks(vec, k=10).filter("track_id % 7 = 0")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_lsh_index_is_the_callers_choice(spark):
    from encore.plans.batch import build_index
    vec = td.vectors(spark, SF_SMALL)
    exact = build_index(vec, k=10)
    approx = build_index(vec, k=10, mode="lsh")
    assert exact.table.count() == approx.table.count() == 10 * exact.n_vectors
    assert recall_at_k(approx.table, exact.table).collect()[0].recall > 0.9


def test_rounding_matches_duckdb():
    import duckdb

    from encore.operators.similar import _round_micro
    rng = np.random.default_rng(11)
    vals = np.concatenate([rng.uniform(-1, 1, 2000), np.array([0.0000005, -0.0000005,
                                                               0.1234565, 0.9999995, -0.25])])
    con = duckdb.connect()
    con.execute("CREATE TABLE v(x DOUBLE)")
    con.executemany("INSERT INTO v VALUES (?)", [(float(x),) for x in vals])
    duck = np.array([r[0] for r in con.execute("SELECT round(x, 6) FROM v").fetchall()])
    ours = _round_micro(vals) / 1e6
    np.testing.assert_array_equal(ours, duck)


def test_copies_of_a_track_collapse(spark):
    from pyspark.sql import functions as F
    vec = td.vectors(spark, SF_SMALL)
    n = vec.count()
    hot = (vec.filter("track_id = 7")
           .withColumn("c", F.explode(F.sequence(F.lit(1), F.lit(n // 2)))).drop("c"))
    copies = vec.unionByName(hot)  # track 7 now holds a third of the rows
    assert copies.filter("track_id = 7").count() * 3 >= copies.count()
    a = similar_tracks(vec, k=10).toPandas().sort_values(["track_id", "rank"])
    b = similar_tracks(copies, k=10).toPandas().sort_values(["track_id", "rank"])
    assert a.reset_index(drop=True).equals(b.reset_index(drop=True))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_score_both_equals_two_directions(seed, monkeypatch):
    import pandas as pd

    import encore.operators.similar as sim
    monkeypatch.setattr(sim, "_QUERY_CHUNK", 7)  # many chunks: exercises the running merge
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(6, 4))
    # few distinct directions, so many exact ties between candidates
    feats = base[rng.integers(0, 6, 60)] * rng.uniform(0.5, 2.0, (60, 1))
    ids = rng.permutation(1000)[:60]
    df = pd.DataFrame({"track_id": ids, "features": list(feats), "label": ids % 5})
    a, b = df.iloc[:25], df.iloc[25:]
    both = pd.concat(sim._score_both(a, b, 10), ignore_index=True)
    one = pd.concat(sim._score(a, b, 10, True) + sim._score(b, a, 10, True), ignore_index=True)
    key = ["track_id", "rank"]
    both = both.sort_values(key).reset_index(drop=True)
    one = one.sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(both, one, check_dtype=False)


def test_scoring_holds_tiles_not_a_block_of_similarities():
    import tracemalloc

    import pandas as pd

    import encore.operators.similar as sim
    rng = np.random.default_rng(5)
    n = 6000
    df = pd.DataFrame({"track_id": np.arange(2 * n), "features": list(rng.normal(size=(2 * n, 8))), "label": 1})
    for run in (lambda: sim._score_both(df[:n], df[n:], 3), lambda: sim._score(df[:n], df[n:], 3, False)):
        tracemalloc.start()
        run()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 60e6  # a chunk of queries against the whole block took several times 24 MB


def test_small_tables_are_cut_for_all_cores():
    import encore.operators.similar as sim
    assert [sim.block_rows_for(n) for n in (500, 10_256, 102_564, 10 ** 7)] == [1024, 1282, 12_821, 16_384]


def _odd_vectors(n, seed):
    """Few directions (ties), opposite ones, copies, vectors without a direction, too long or no number."""
    import pandas as pd
    rng = np.random.default_rng(seed)
    base = np.concatenate([rng.normal(size=(9, 4)), -np.ones((1, 4)), np.ones((1, 4))])
    feats = base[rng.integers(0, len(base), n)] * rng.choice([1e-3, 0.5, 7.0], (n, 1))
    feats[rng.integers(0, n, 3)] = 0.0
    feats[rng.integers(0, n, 2)] = 1e200
    feats[rng.integers(0, n, 2), 1] = np.nan
    return pd.DataFrame({"track_id": rng.permutation(10 * n)[:n], "features": list(feats),
                         "label": rng.integers(0, 5, n).astype(np.int32)})


@pytest.mark.parametrize("k", [1, 10, 500])
@pytest.mark.parametrize("chunk", [7, 512])
def test_lists_of_odd_vectors_equal_a_full_ranking(k, chunk, monkeypatch):
    import pandas as pd

    import encore.operators.similar as sim
    monkeypatch.setattr(sim, "_QUERY_CHUNK", chunk)
    monkeypatch.setattr(sim, "_CAND_CHUNK", chunk)
    df = _odd_vectors(150, 4)
    a, b = df.iloc[:90], df.iloc[90:]

    def ranked(queries, cands, own):
        q_ids, _, qmat, q_norm = sim._block(queries)
        c_ids, c_lab, cmat, c_norm = sim._block(cands)
        with np.errstate(all="ignore"):
            cos = (qmat @ cmat.T) / np.outer(q_norm, c_norm)
            micro = sim._round_micro(np.where(np.isfinite(cos), cos, 0.0))
        rows = []
        for i, t in enumerate(q_ids):
            found = sorted((-micro[i, j], c_ids[j], c_lab[j]) for j in range(len(c_ids))
                           if np.isfinite(cos[i, j]) and (own or c_ids[j] != t))
            rows += [(t, c, -m, lab, r + 1) for r, (m, c, lab) in enumerate(found[:k])]
        return rows

    def rows(parts):
        return sorted(map(tuple, pd.concat(parts, ignore_index=True).itertuples(index=False)))
    assert rows(sim._score_both(a, b, k)) == sorted(ranked(a, b, True) + ranked(b, a, True))
    assert rows(sim._score(df, df, k, False)) == sorted(ranked(df, df, False))
    assert rows(sim._score(df, df, k, True)) == sorted(ranked(df, df, True))


def test_only_pairs_that_can_enter_a_list_are_ranked(monkeypatch):
    import pandas as pd

    import encore.operators.similar as sim
    ranked, plain = [], sim._round_micro

    def counted(values):
        ranked.append(values.size)
        return plain(values)
    monkeypatch.setattr(sim, "_round_micro", counted)
    rng = np.random.default_rng(6)
    n = 3000
    df = pd.DataFrame({"track_id": np.arange(2 * n), "features": list(rng.normal(size=(2 * n, 8))), "label": 1})
    for run in (lambda: sim._score_both(df[:n], df[n:], 5), lambda: sim._score(df[:n], df[:n], 5, False)):
        ranked.clear()
        run()
        assert sum(ranked) < n * n / 20  # all n * n pairs before

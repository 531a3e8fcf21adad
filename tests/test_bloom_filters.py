"""Bloom filter properties and filter selectivity on the test tables."""

import pytest

from tests.conftest import SF_MID
from encore.catalog import _today_candidates
from encore.operators import filters as flt
from encore.operators.bloom import filter_dismissed_bloom
from encore.sources import testdata as td


@pytest.mark.parametrize("part_items", [4096, 3])
def test_bloom_no_false_negative_and_bounded_fp(spark, part_items):
    cands = _today_candidates(spark, SF_MID).cache()
    dis = td.dismissals(spark, SF_MID)
    exact = flt.filter_dismissed(cands, dis)
    bloom = filter_dismissed_bloom(cands, dis, fp_rate=0.01, part_items=part_items).cache()
    # never keeps a dismissed pair
    assert bloom.join(dis, ["user_id", "track_id"], "left_semi").count() == 0
    # drops only a few extra rows
    n_exact, n_bloom = exact.count(), bloom.count()
    assert bloom.join(exact, ["user_id", "track_id"], "left_anti").count() == 0
    assert n_bloom <= n_exact and (n_exact - n_bloom) / n_exact < 0.03


def removes_some_keeps_some(before, after):
    b, a = before.count(), after.count()
    assert 0 < a < b, (a, b)


def test_filters_act(spark):
    hist = td.history(spark, SF_MID)
    recent = flt.filter_recent(hist, td.HISTORY_AS_OF)
    removes_some_keeps_some(hist, recent)
    any_ = flt.filter_active_tracks(recent, td.HISTORY_AS_OF, mode="any")
    all_ = flt.filter_active_tracks(recent, td.HISTORY_AS_OF, mode="all")
    removes_some_keeps_some(recent, any_)
    removes_some_keeps_some(recent, all_)
    assert any_.count() < all_.count()
    removes_some_keeps_some(recent, flt.filter_active_users(recent, 10))
    removes_some_keeps_some(hist, flt.sample_users(hist, 100))
    cands = _today_candidates(spark, SF_MID)
    removes_some_keeps_some(cands, flt.filter_dismissed(cands, td.dismissals(spark, SF_MID)))

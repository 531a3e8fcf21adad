"""Physical-plan properties that the scale design relies on."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

QUERIES = entry.queries()
STREAMING = {k for k in QUERIES if k.startswith("stream_")}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - STREAMING - {"stage_counts"}))
def test_no_cross_or_nested_loop_join(spark, key):
    text = plan(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_top_n_is_limited_before_the_shuffle(spark):
    text = plan(QUERIES["user_top_n"](spark, SF_SMALL))
    assert "WindowGroupLimit" in text
    # a partial limit sits below the exchange on user_id
    head = text.split("\n\n")[0]
    assert head.count("WindowGroupLimit") >= 2


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["filter_recent"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(l_shipdate,1998-11-04" in text
    text = plan(QUERIES["event_candidates"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-25" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double," \
           "props:string>" in text


def test_similar_table_broadcast_only_when_bounded(spark):
    from encore.operators.recommend import event_candidates, weigh_events
    from encore.sources import testdata as td
    sim = spark.createDataFrame([(1, 2, 0.5)], "track_id long, similar_track_id long, "
                                               "similarity double")
    events = weigh_events(td.daily(spark, SF_SMALL))
    small = plan(event_candidates(events, sim, similar_rows_bound=10))
    assert "BroadcastHashJoin" in small
    with_off = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = plan(event_candidates(events, sim, similar_rows_bound=10 ** 9))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_off)
    assert "BroadcastHashJoin" not in big and "SortMergeJoin" in big

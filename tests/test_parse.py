"""Hand-computed parser rows (FIXTURES 3)."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from encore.functions.parse import (parse_daily, parse_daily_lines, parse_ratings,
                                    quarantine, to_als_rating)
from encore.operators.partitions import parse_daily_in_pandas
from encore.operators.recommend import refused_events
from encore.session import scratch_path
from encore.sources.text import scan_lines, to_rating_lines, write_lines


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_daily_line(spark):
    row = parse_daily(lines(spark, ["17,42,1445047130,0.6,browsing,null"])).collect()[0]
    assert (row.user_id, row.track_id, row.ms_played, row.reason_start) == (17, 42, 0.6,
                                                                            "browsing")
    assert row.ts == dt.datetime(2015, 10, 17, 1, 58, 50)
    assert row.reason_end is None


def test_trailing_empty_field_is_kept(spark):
    rows = parse_daily(lines(spark, ["17,42,1445047130,0.6,browsing,"])).collect()
    assert len(rows) == 1 and rows[0].reason_end == ""


def test_quarantine_reasons(spark):
    parsed = parse_daily_lines(lines(spark, ["17,42,1445047130,0.6,browsing",
                                             "17,42,x,0.6,browsing,null",
                                             "17,42,1445047130,0.6,browsing,null"]))
    bad = {r.line: r.parse_error for r in quarantine(parsed).collect()}
    assert bad == {"17,42,1445047130,0.6,browsing": "expected 6 fields, found 5",
                   "17,42,x,0.6,browsing,null": "bad timestamp"}


def test_failfast_raises(spark):
    import pytest
    with pytest.raises(Exception):
        parse_daily(lines(spark, ["1,2,3"]), mode="failfast").collect()


def test_rating_line(spark):
    row = parse_ratings(lines(spark, ["17,42,1445047130,20311"])).collect()[0]
    assert (row.user_id, row.track_id, row.rating) == (17, 42, 20311.0)


def test_als_rating_never_loses_an_id_silently(spark):
    df = spark.createDataFrame([(1, 2, 3.0), (3_000_000_000, 2, 1.0), (None, 2, 1.0)],
                               "user_id long, track_id long, rating double")
    with pytest.raises(Exception, match="user_id outside INT: 3000000000"):
        to_als_rating(df).collect()
    kept = to_als_rating(df, out_of_range="drop").collect()
    assert [tuple(r) for r in kept] == [(1, 2, 3.0)]


def test_refused_events_say_why(spark):
    vals = ["1,2,1445047130,5.0,rec,null", "1,2,1445047130,5.0,telepathy,null", "x,2,1,1.0,rec,null",
            "1,2,1445047130,123456789012,rec,null", "1,2,1445047130,NaN,rec,null"]
    got = {r.line: r.parse_error for r in refused_events(parse_daily_lines(lines(spark, vals))).collect()}
    assert got == {vals[1]: "unknown reason", vals[2]: "bad user_id",
                   vals[3]: "ms_played too large for a weight", vals[4]: "bad ms_played"}


def test_a_null_is_an_empty_field(spark):
    df = spark.createDataFrame([(1, 2, None, None)], "user_id long, track_id long, ts timestamp_ntz, rating double")
    assert [r.value for r in to_rating_lines(df).collect()] == ["1,2,,"]


def test_absent_paths_are_skipped(spark):
    there = write_lines(lines(spark, ["a"]), scratch_path(spark, "lines"))
    gone = there + "-tomorrow"
    assert scan_lines(spark, gone, ignore_missing=True).count() == 0
    assert scan_lines(spark, gone + "/*.txt", ignore_missing=True).count() == 0
    assert [r.value for r in scan_lines(spark, [gone, there], ignore_missing=True).collect()] == ["a"]
    with pytest.raises(AnalysisException):
        scan_lines(spark, gone)


def test_pandas_parser_matches(spark):
    vals = ["17,42,1445047130,0.6,browsing,null", "1,2,3", "5,6,1445047131,1.5,rec,radio"]
    a = sorted(tuple(r) for r in parse_daily(lines(spark, vals)).collect())
    b = sorted(tuple(r) for r in parse_daily_in_pandas(lines(spark, vals)).collect())
    assert a == b


def test_hostile_fields_are_quarantined_alike_by_both_parsers(spark):
    from encore.functions.parse import parse_daily, parse_ratings
    from encore.operators.partitions import parse_daily_in_pandas
    fields = ["9007199254740993", "1e3", "1.0", " 7 ", "+8", "-9", "9223372036854775808", "", "x", "99999999999999999"]
    lines = [f"{f},2,1000,3.5,a,b" for f in fields] + [f"1,{f},1000,3.5,a,b" for f in fields]
    lines += [f"1,2,{f},3.5,a,b" for f in fields]
    lines += [f"1,2,1000,{p},a,b" for p in ("NaN", "Infinity", "-Infinity", "1e3", "", "x", " 4.5")]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    want = sorted(map(str, parse_daily(frame).collect()))
    assert want and sorted(map(str, parse_daily_in_pandas(frame).collect())) == want
    ratings = spark.createDataFrame([(f"1,2,1000,{r}",) for r in ("NaN", "Infinity", "0.0000004")], "value string")
    assert [r.rating for r in parse_ratings(ratings).collect()] == [0.0000004]


def test_only_local_masters_get_a_local_checkpoint_folder():
    import pytest

    from encore.session import local_checkpoint_dir
    assert local_checkpoint_dir("local[4]")
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError):
            local_checkpoint_dir(master)

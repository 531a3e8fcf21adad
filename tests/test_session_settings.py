"""Results do not depend on the session time zone or on ANSI mode."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_compare import duck, rows

KEYS = ["parse_daily", "scan_daily_lines", "stream_track_window", "filter_recent",
        "merge_ratings", "sink_merged_ratings", "batch_recommendations"]
SETTINGS = [("spark.sql.session.timeZone", "America/Los_Angeles"),
            ("spark.sql.session.timeZone", "Asia/Kolkata"),
            ("spark.sql.ansi.enabled", "false")]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("setting", SETTINGS, ids=lambda s: f"{s[0].split('.')[-1]}={s[1]}")
@pytest.mark.parametrize("key", KEYS)
def test_same_result_under_setting(spark, con, key, setting):
    conf_key, value = setting
    before = spark.conf.get(conf_key)
    spark.conf.set(conf_key, value)
    try:
        got = entry.queries()[key](spark, SF_SMALL).toPandas()
    finally:
        spark.conf.set(conf_key, before)
    want = con.execute(entry.oracle_sql()[key]).df()
    assert rows(got) == rows(want)

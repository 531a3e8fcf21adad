"""A hot user holding a third of all events: results still equal the oracles.

The fixture is derived from the sf0.001 tables (test only): half of the
events are copied onto user 7, so user 7 holds a third of the rows and
replays the same tracks many times.
"""

import os
import shutil
import tempfile

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_compare import duck, rows

KEYS = ["batch_recommendations", "event_candidates", "user_top_n", "merge_ratings",
        "events_by_track", "filter_dismissed", "stream_recommendations"]


@pytest.fixture(scope="module")
def skew_dir():
    d = tempfile.mkdtemp(prefix="encore-skew-")
    for name in os.listdir(SF_SMALL):
        if name != "events.parquet":
            shutil.copy(os.path.join(SF_SMALL, name), d)
    ev = pq.read_table(os.path.join(SF_SMALL, "events.parquet"))
    half = ev.slice(0, ev.num_rows // 2)
    offset = pc.max(ev["event_id"]).as_py() + 1
    hot = half.set_column(half.schema.get_field_index("user_id"), "user_id",
                          pa.array([7] * half.num_rows, ev["user_id"].type))
    hot = hot.set_column(hot.schema.get_field_index("event_id"), "event_id",
                         pc.add(hot["event_id"], offset).cast(ev["event_id"].type))
    pq.write_table(pa.concat_tables([ev, hot]), os.path.join(d, "events.parquet"))
    return d


def test_fixture_is_skewed(skew_dir):
    ev = pq.read_table(os.path.join(skew_dir, "events.parquet"))
    share = pc.sum(pc.equal(ev["user_id"], 7)).as_py() / ev.num_rows
    assert share >= 1 / 3


@pytest.mark.parametrize("key", KEYS)
def test_hot_user_matches_oracle(spark, skew_dir, key):
    got = entry.queries()[key](spark, skew_dir).toPandas()
    want = duck(skew_dir).execute(entry.oracle_sql()[key]).df()
    assert len(got) == len(want)
    assert rows(got) == rows(want)

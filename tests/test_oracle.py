"""Every query against its DuckDB oracle (or, without one, that it runs), at sf0.001."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_compare import duck, duck_rows, objects, rows

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE",
                 "StringType": "VARCHAR", "TimestampNTZType": "TIMESTAMP",
                 "BooleanType": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    got = objects(df.columns, df.collect())
    if key not in ORACLE:
        assert len(got) > 0
        return
    want = duck_rows(con, ORACLE[key])
    assert sorted(got.columns) == sorted(want.columns)
    spark_types = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, str(f.dataType))
                   for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLE[key]}").fetchall()}
    assert spark_types == duck_types
    assert len(got) == len(want)
    assert rows(got) == rows(want)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "rank", "track_id", "score", "base_score"]
    assert df.count() > 0

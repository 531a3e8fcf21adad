"""Run queries() against oracle_sql() the way the driver does, locally.

    python -m tests.oracle_compare [sf_dir] [key ...]

Compares row count, column names and the order-insensitive multiset of rows
(floats compared after rounding to 9 significant decimals).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def objects(columns: list[str], values) -> pd.DataFrame:
    """Rows as they were fetched: a NULL stays None and a BIGINT an int, where
    ``toPandas`` and ``df`` make some such columns floats with NaN."""
    return pd.DataFrame([tuple(v) for v in values], columns=columns, dtype=object)


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> pd.DataFrame:
    done = con.execute(sql)
    return objects([d[0] for d in done.description], done.fetchall())


STRICT = False


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if type(v).__name__ == "Decimal":
        return float(v) if STRICT else round(float(v), 9)
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def compare(spark, sf_dir: str, keys: list[str] | None = None) -> dict[str, dict]:
    import __spark_entry__ as e
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for key in keys or list(qs):
        t0 = time.time()
        res = {"oracle": key in sqls}
        try:
            sdf = qs[key](spark, sf_dir).toPandas()
            res["spark_rows"] = len(sdf)
            res["spark_sec"] = round(time.time() - t0, 2)
            if key in sqls:
                ddf = con.execute(sqls[key]).df()
                res["oracle_rows"] = len(ddf)
                res["columns_match"] = sorted(sdf.columns) == sorted(ddf.columns)
                if res["columns_match"]:
                    a, b = rows(sdf), rows(ddf)
                    res["values_match"] = a == b
                    if not res["values_match"]:
                        sa, sb = set(a), set(b)
                        res["only_spark"] = list(sa - sb)[:3]
                        res["only_oracle"] = list(sb - sa)[:3]
                else:
                    res["spark_cols"], res["oracle_cols"] = list(sdf.columns), list(ddf.columns)
        except Exception as exc:  # report and continue
            res["error"] = f"{type(exc).__name__}: {str(exc)[:400]}"
        report[key] = res
        ok = res.get("values_match", res.get("spark_rows") is not None and "error" not in res)
        print(("OK   " if ok else "FAIL ") + key, res, flush=True)
    return report


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from encore.session import build_session
    if "--strict" in sys.argv:
        sys.argv.remove("--strict")
        STRICT = True
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    compare(spark, sf, sys.argv[2:] or None)

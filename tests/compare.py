"""Run catalog queries against their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = ("documents", "conversations", "pages", "labels", "benchmark")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), kind="stable").reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """What differs, if anything; doubles within 1e-6."""
    got, want = normal(spark_frame), normal(sql_frame)
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} != {list(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    types = [(c, got[c].dtype, want[c].dtype) for c in got if got[c].dtype != want[c].dtype]
    if types:
        return f"types {types}"
    for c in got.columns:
        if got[c].dtype.kind == "f":
            same = (got[c] - want[c]).abs().fillna(0) <= 1e-6
        else:
            same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        if not same.all():
            at = same.idxmin()
            return f"{c}: {(~same).sum()} differ, first {got.loc[at].to_dict()} {want.loc[at].to_dict()}"[:1500]
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from quillprep.session import local_session

    sf = sys.argv[1]
    spark, con = local_session(), duck(sf)
    sql = oracle_sql()
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        try:
            t0 = time.time()
            got = query(spark, sf).toPandas()
            t1 = time.time()
            if name not in sql:
                print(f"{name:26s} rows only {len(got)} {t1 - t0:.2f}s", flush=True)
                continue
            want = con.execute(sql[name]).df()
            print(f"{name:26s} {difference(got, want) or 'ok'} rows={len(got)} {t1 - t0:.2f}s sql {time.time() - t1:.2f}s", flush=True)
        except Exception as error:
            print(f"{name:26s} FAILED {str(error)[:1200]}", flush=True)

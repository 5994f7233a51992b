"""Compare registered queries with their SQL, run in DuckDB on the same files.

    python tests/oracle.py SF_DIR [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype == object and df[c].notna().any() and hasattr(df[c].dropna().iloc[0], "isoformat"):
            df[c] = pd.to_datetime(df[c])
        if str(df[c].dtype).startswith("datetime64"):
            df[c] = df[c].astype("datetime64[us]")
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """None where both hold the same rows, else what differs."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(set(ours.columns) ^ set(theirs.columns))}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    a, b = _plain(ours), _plain(theirs)
    types = [f"{c}: {a[c].dtype} / {b[c].dtype}" for c in a.columns if a[c].dtype != b[c].dtype and a[c].notna().all()]
    if types:
        return "types " + "; ".join(types)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = (~same).idxmax()
            return f"{c}: {(~same).sum()} rows, e.g. {a.loc[i].to_dict()} / {b.loc[i].to_dict()}"
    return None


def main() -> int:
    import __spark_entry__ as contract
    from stationflow.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    queries, sql = contract.queries(), contract.oracle_sql()
    bad = 0
    for name in names or queries:
        begin = time.time()
        try:
            ours = queries[name](spark, sf_dir).toPandas()
            spent = time.time() - begin
            problem = difference(ours, con.execute(sql[name]).df()) if name in sql else None
            state = ("FAIL " + problem) if problem else ("ok" if name in sql else "rows only")
        except Exception as error:  # noqa: BLE001
            spent, state, ours = time.time() - begin, f"ERROR {str(error)[:1500]}", []
        bad += state.startswith(("FAIL", "ERROR"))
        print(f"{name:32s} {len(ours):7d} rows {spent:6.2f}s  {state}", flush=True)
    print(f"{bad} of {len(names or queries)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())

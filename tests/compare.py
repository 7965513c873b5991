"""Run queries next to their SQL counterparts and compare all values."""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), kind="stable").reset_index(drop=True)


def difference(mine: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    a, b = canonical(mine), canonical(theirs)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            at = (~same).idxmax()
            return f"{c}: {int((~same).sum())} differ, first {a[c][at]!r} != {b[c][at]!r}"
    return None


def main(names: list[str], folder: str) -> int:
    import __spark_entry__ as entry
    from modeforge.session import local_session

    spark, con = local_session(), connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        started = time.monotonic()
        try:
            mine = queries[name](spark, folder).toPandas()
            spent = time.monotonic() - started
            found = (
                difference(mine, con.execute(oracle[name]).df())
                if name in oracle
                else f"no SQL ({len(mine)} rows)"
            )
        except Exception:
            spent, found = time.monotonic() - started, traceback.format_exc(limit=3)[-1500:]
        bad += found is not None
        print(f"{name:28s} {spent:6.2f}s {found or 'ok'}", flush=True)
    print("not matching:", bad)
    return bad


if __name__ == "__main__":
    main(sys.argv[2:], sys.argv[1])

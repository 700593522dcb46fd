"""Side-by-side check of a registered query against its SQL oracle (DuckDB).

Used by the test-suite and ``python -m tests.compare``. Results
are compared as the checker does: row count, column names, and an
order-insensitive comparison of values with columns sorted by name.
"""

from __future__ import annotations

import math
import sys
import time
from collections.abc import Iterable

import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):  # numpy scalar
        return _norm(v.item())
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(v) for v in row) for row in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_df.columns) != sorted(oracle_df.columns):
        return False, f"columns differ: {sorted(spark_df.columns)} vs {sorted(oracle_df.columns)}"
    if len(spark_df) != len(oracle_df):
        return False, f"row count {len(spark_df)} vs {len(oracle_df)}"
    a, b = _rows(spark_df), _rows(oracle_df)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. {bad[0][0]} vs {bad[0][1]}"
    return True, f"{len(a)} rows equal"


def check(spark, sf_dir: str, names: Iterable[str] | None = None, verbose: bool = True):
    from incidentlake.plans.oracle import oracle_sql
    from incidentlake.plans.queries import queries

    qs, sqls = queries(), oracle_sql()
    con = duckdb_connection(sf_dir)
    results = {}
    for name in names or qs:
        t0 = time.perf_counter()
        sdf = qs[name](spark, sf_dir).toPandas()
        t1 = time.perf_counter()
        if name in sqls:
            con.execute(f"CREATE OR REPLACE VIEW checked AS {sqls[name]}")  # one plain statement
            odf = con.execute("SELECT * FROM checked").df()
            ok, msg = compare(sdf, odf)
        else:
            ok, msg = True, f"{len(sdf)} rows (no oracle)"
        results[name] = (ok, msg, t1 - t0)
        if verbose:
            print(f"{'OK  ' if ok else 'FAIL'} {name:24s} {t1 - t0:6.2f}s  {msg}", flush=True)
    return results


if __name__ == "__main__":
    from incidentlake.config import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:] or None
    res = check(local_session(), sf, only)
    failed = [k for k, v in res.items() if not v[0]]
    print("failed:", failed)
    raise SystemExit(1 if failed else 0)

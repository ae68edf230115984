"""Spark-vs-DuckDB comparison used by the tests and for local iteration.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
Comparison: same column names, same row count, and equal values after
sorting columns by name and rows by all columns (floats to 1e-6 relative).
"""

from __future__ import annotations

import math
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

# Floats must agree to 1e-12 relative (the driver hashes values, so the
# contract is "same number", not "close").
REL_TOL = float(os.environ.get("COMPARE_REL_TOL", "1e-12"))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: spark-only {set(s.columns) - set(d.columns)} sql-only {set(d.columns) - set(s.columns)}"
    if len(s) != len(d):
        return False, f"rows differ: spark {len(s)} sql {len(d)}"
    rs, rd = rows_of(s), rows_of(d)
    for a, b in zip(rs, rd):
        for x, y, c in zip(a, b, sorted(s.columns)):
            if isinstance(x, float) and isinstance(y, float):
                if not math.isclose(x, y, rel_tol=REL_TOL, abs_tol=0.0):
                    return False, f"value differs in {c}: {x} vs {y}\n spark {a}\n sql   {b}"
            elif x != y:
                return False, f"value differs in {c}: {x!r} vs {y!r}\n spark {a}\n sql   {b}"
    return True, f"{len(s)} rows"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from voltgrid.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for n in names or sorted(qs):
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print(f"{n:40s} ROWS-ONLY {df.count()} rows")
            continue
        try:
            ok, msg = compare(qs[n](spark, sf_dir), sqls[n], con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{n:40s} {'OK ' if ok else 'BAD'} {msg}", flush=True)
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

"""Runs registered queries on both engines and compares whole results."""
from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    """One form for values both engines may give in different types."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, int):
        return float(value) if abs(value) < 1 << 53 else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> str:
    """Empty text when the results agree, else what differs."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return "" if got else "no rows"
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if not want:
        return "oracle gives no rows"
    if got != want:
        extra, missing = got - want, want - got
        return (f"{sum(got.values())} rows against {sum(want.values())}; "
                f"extra {list(extra)[:2]} missing {list(missing)[:2]}")
    return ""


def main() -> int:
    import __spark_entry__ as entry
    from lakeproof.session import local_session
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark, con = local_session(), duck(sf_dir)
    oracle, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        mark = "ok  " if not problem else "FAIL"
        print(f"{mark} {name:28s} {time.time() - start:6.2f}s {problem}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())

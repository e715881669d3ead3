"""Comparison of a registered query with its oracle SQL in DuckDB.

    python tests/oracle.py [folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from mirrorspan.registry import ORACLES, QUERIES  # noqa: E402
from mirrorspan.registry.core import TABLES  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, int):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, name: str) -> str | None:
    """None when equal, otherwise what differs."""
    df = QUERIES[name](spark, folder)
    got = df.collect()
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    a, b = _bag(df.columns, got), _bag(names, want)
    if a != b:
        return (
            f"{len(got)} rows instead of {len(want)}; "
            f"only here {list((a - b).items())[:3]}; only oracle {list((b - a).items())[:3]}"
        )
    return None


if __name__ == "__main__":
    from mirrorspan.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = local_session("oracle", 8)
    session.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for key in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            problem = compare(session, con, folder, key)
        except Exception as exc:
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += problem is not None
        rows = con.execute(f"SELECT count(*) FROM ({ORACLES[key]})").fetchone()[0] if problem is None else ""
        print(f"{'ok  ' if problem is None else 'FAIL'} {key} {time.time() - start:.2f}s {rows} {problem or ''}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or QUERIES)} differ")

"""Run registered queries against DuckDB: python tests/check_oracle.py [sf] [name-prefix ...]"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from tidemark.sources.fixtures import BASE_TABLES  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"{float(v):.10g}" if float(v) != 0 else "0"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = cur.fetchall()
    ours = [tuple(x) for x in df.collect()]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    a = sorted(tuple(norm(row[df.columns.index(n)]) for n in order) for row in ours)
    b = sorted(tuple(norm(row[names.index(n)]) for n in order) for row in theirs)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}; spark {a[:2]} duck {b[:2]}"
    for x, y in zip(a, b):
        if x != y:
            return f"{order}: spark {x} duck {y}"
    return None if a else "EMPTY"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import local_session

    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    prefixes = tuple(args[1:])
    folder = f"/root/testdata/sf{sf}"
    # CHECK_CONF="key=value;key=value" tries the queries under other session settings.
    extra = dict(kv.split("=", 1) for kv in os.environ.get("CHECK_CONF", "").split(";") if kv)
    spark = local_session("oracle-check", **extra)
    con = connect(folder)
    oracles = oracle_sql()
    bad = 0
    for name, build in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                n = df.count()
                problem = None if n else "EMPTY"
                name += " (rows only)"
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        took = time.time() - start
        if problem:
            bad += 1
            print(f"BAD {name} {took:.1f}s {problem[:900]}", flush=True)
        else:
            print(f"ok  {name} {took:.1f}s", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())

"""Runs a query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def connect(sf: str):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(p).removesuffix(".parquet")
        src = f"{p}/*.parquet" if os.path.isdir(p) else p
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{src}')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else float(f"{v:.9g}"))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if hasattr(v, "as_tuple"):
        return plain(float(v))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


took: dict[str, float] = {}


def compare(spark, name, query, sql, sf):
    """An error text, or '' where both agree."""
    df = query(spark, sf)
    t = time.time()
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    took[name] = time.time() - t
    con = connect(sf)
    res = con.execute(sql)
    want = rows([d[0] for d in res.description], res.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} and {want[0]}"
    if got[1] == want[1]:
        return ""
    if len(got[1]) == len(want[1]):
        pairs = [(a, b) for a, b in zip(got[1], want[1], strict=True) if a != b and not close(a, b)]
        if not pairs:
            return ""
        return f"{len(pairs)} of {len(got[1])} rows differ, first {pairs[0]}"
    a, b = set(got[1]), set(want[1])
    return f"{len(got[1])} rows and {len(want[1])}; only ours {list(a - b)[:2]}, only SQL {list(b - a)[:2]}"


def close(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple) and len(a) == len(b):
        return all(close(x, y) for x, y in zip(a, b, strict=True))
    if isinstance(a, float) and isinstance(b, (int, float)):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from evigraph.session import get_session

    spark = get_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf, only = sys.argv[1], sys.argv[2:]
    q, s = e.queries(), e.oracle_sql()
    bad = 0
    for n in q:
        if only and not any(n.startswith(x) for x in only):
            continue
        t = time.time()
        try:
            if n in s:
                why = compare(spark, n, q[n], s[n], sf)
                n_rows = ""
            else:
                why, n_rows = "", f"{q[n](spark, sf).count()} rows, no SQL"
        except Exception as x:  # noqa: BLE001
            why, n_rows = f"{type(x).__name__}: {str(x)[:600]}", ""
        bad += bool(why)
        print(f"{'BAD' if why else 'ok '} {n} {time.time() - t:.1f}s (collect {took.get(n, 0):.1f}) {n_rows} {why}", flush=True)
    print("bad:", bad)

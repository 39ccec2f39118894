"""Compare queries with their oracle SQL. Run as a script: python tests/oracle.py [sf_dir] [name part …]"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    """Typed text: whole numbers and doubles must not be mixed up."""
    if v is None:
        return "~"
    if isinstance(v, float):
        if math.isnan(v):
            return "~"
        return f"f{0.0 if v == 0 else v!r}"
    if isinstance(v, bool):
        return f"b{v}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(cell(x) for x in v) + "]"
    return f"{type(v).__name__}:{v}"


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, fn, sql):
    """None when equal, else a description."""
    df = fn(spark, sf_dir)
    got = normal(df.columns, df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = normal(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        only_got, only_want = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
        return f"{len(got)} rows vs {len(want)}\n   spark  {only_got}\n   oracle {only_want}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from reelspark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = local_session()
    con = connect(sf)
    oracle, bad = entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        t = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, sf, fn, oracle[name])
            else:
                problem = None
                print("no oracle,", fn(spark, sf).count(), "rows:", name)
        except Exception as e:  # report and go on
            problem = str(e)[:600] if "-v" not in sys.argv else traceback.format_exc()
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - t:.1f}s")
        if problem:
            print("   ", problem)
            bad.append(name)
    print(len(bad), "failed:", " ".join(bad))

"""Compare catalogue queries with their DuckDB oracle. Usage: python tests/oracle_check.py [sf] [name-prefix ...]"""

from __future__ import annotations

import logging
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0
    return v


def duck(sf_dir):
    import duckdb

    from affinora.fixtures import TABLES

    con = duckdb.connect()
    con.execute("set threads=8")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql):
    cols = spark_df.columns
    got = rows_of(cols, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    want = rows_of(ocols, cur.fetchall())
    if sorted(cols) != sorted(ocols):
        return False, f"columns {sorted(cols)} vs {sorted(ocols)}", len(got)
    if len(got) != len(want):
        return False, f"rows {len(got)} vs {len(want)}; spark {got[:2]} duck {want[:2]}", len(got)
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return False, f"{sorted(cols)}\n   spark {a}\n   duck  {b}", len(got)
    return True, "", len(got)


def main(argv):
    sf = argv[0] if argv else "0.01"
    prefixes = argv[1:]
    import __spark_entry__ as catalog
    from affinora.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("OFF")
    logging.disable(logging.CRITICAL)
    sf_dir = f"/root/testdata/sf{sf}"
    con = duck(sf_dir)
    queries, oracle = catalog.queries(), catalog.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracle:
                ok, why, n = compare(df, con, oracle[name])
            else:
                n = df.count()
                ok, why = True, "rows only"
        except Exception as exc:  # report and go on
            ok, why, n = False, f"{type(exc).__name__}: {str(exc)[:300]}", -1
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} rows={n:<8d} {time.time() - start:6.2f}s {why}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

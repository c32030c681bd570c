"""Compare registered queries with their SQL on one data folder.

Usage: python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def key(row):
    return tuple((v is None, str(type(v)) if not isinstance(v, (int, float)) else "", v if v is not None else 0) for v in row)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(body, key=key)


def same(a, b, tolerance=0.0):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance)
    return a == b and (isinstance(a, bool) == isinstance(b, bool)) and (isinstance(a, float) == isinstance(b, float))


def check(spark, con, name, query, sql, sf_dir):
    """None when both agree, else what differs."""
    df = query(spark, sf_dir)
    cols, mine = table(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs_cols, theirs = table(names, cur.fetchall())
    if cols != theirs_cols:
        return f"columns {cols} vs {theirs_cols}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    bad = [(x, y) for x, y in zip(mine, theirs) if not all(same(a, b) for a, b in zip(x, y))]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, e.g. {[(c, a, b) for c, a, b in zip(cols, *bad[0]) if not same(a, b)]}"
    return "" if mine else "no rows"


def main():
    from __spark_entry__ import oracle_sql, queries
    from lumitrace.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false", spark_ui_showConsoleProgress="false", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = oracle_sql()
    for name, fn in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if name in sqls:
                result = check(spark, con, name, fn, sqls[name], sf_dir)
                print(f"{'ok  ' if result == '' else 'FAIL'} {name} {time.time() - start:.2f}s {result}", flush=True)
            else:
                n = len(fn(spark, sf_dir).collect())
                print(f"rows {name} {time.time() - start:.2f}s {n}", flush=True)
        except Exception as e:  # keep going, report at the end of the line
            print(f"ERR  {name} {time.time() - start:.2f}s {type(e).__name__}: {str(e)[:600]}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

"""Run queries and their SQL side by side: python tests/compare.py [sf_dir] [names...]"""

import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from precinct.session import get_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda v: "NaN" if isinstance(v, float) and v != v else repr(v)
    return sorted(columns), sorted(tuple(text(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, name, sf_dir, sql):
    df = entry.queries()[name](spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return True, f"{len(got[1])} rows, no SQL"
    cur = con.execute(sql)
    want = canonical([c[0] for c in cur.description], cur.fetchall())
    if got == want:
        return True, f"{len(got[1])} rows"
    only = [r for r in got[1] if r not in set(want[1])][:3]
    miss = [r for r in want[1] if r not in set(got[1])][:3]
    return False, f"columns {got[0] == want[0]} {got[0]} {want[0]} rows {len(got[1])} / {len(want[1])}\n  spark {only}\n  sql   {miss}"


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = get_session(master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf), entry.oracle_sql(), 0
    for n in names:
        start = time.time()
        try:
            ok, what = compare(spark, con, n, sf, sqls.get(n))
        except Exception:
            ok, what = False, traceback.format_exc()[-1800:]
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {n:26s} {time.time() - start:6.2f}s {what}", flush=True)
    print("failed", bad)

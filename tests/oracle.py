"""Run queries in Spark and their SQL in DuckDB and compare the rows.

    python tests/oracle.py [--sf 0.001] [key ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, key: str, sf_dir: str) -> str | None:
    """Nothing when Spark and DuckDB agree, else what differs."""
    from weirflow.plans import ORACLES, QUERIES

    df = QUERIES[key](spark, sf_dir)
    got_cols, got = _bag(df.columns, [tuple(r) for r in df.collect()])
    if key not in ORACLES:
        return None if got else "no rows"
    cur = con.execute(ORACLES[key])
    want_cols, want = _bag([d[0] for d in cur.description], cur.fetchall())
    types = dict(df.dtypes)
    kinds = {d[0]: str(d[1]) for d in cur.description}
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    loose = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    bad = [(c, types[c], kinds[c]) for c in got_cols if loose.get(types[c]) != kinds[c]]
    if got != want:
        extra, missing = got - want, want - got
        return f"rows {sum(got.values())} vs {sum(want.values())}; extra {list(extra.items())[:3]} missing {list(missing.items())[:3]}"
    return f"types {bad}" if bad else None


def main() -> int:
    from weirflow.plans import QUERIES
    from weirflow.session import build_session

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.001")
    args.add_argument("--split-rows", type=int)
    args.add_argument("keys", nargs="*")
    a = args.parse_args()
    sf_dir = f"/root/testdata/sf{a.sf}"
    spark = build_session("oracle", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    if a.split_rows:
        spark.conf.set("spark.weirflow.splitRows", str(a.split_rows))
    con = connect(sf_dir)
    failed = 0
    for key in a.keys or list(QUERIES):
        t = time.time()
        try:
            problem = compare(spark, con, key, sf_dir)
        except Exception as e:  # report and go on with the other queries
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {key} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

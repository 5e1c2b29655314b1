"""Run registered queries in Spark and their DuckDB oracle; compare results.

usage: python tools/compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from retail_insight.catalog import QUERIES  # noqa: E402
from retail_insight.oracle import SQL  # noqa: E402
from retail_insight.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:] or list(QUERIES)
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    bad = 0
    for key in keys:
        t0 = time.time()
        df = QUERIES[key](spark, sf_dir)
        cols = df.columns
        rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if key not in SQL:
            print(f"{key:32s} spark rows={len(rows):6d} {t1 - t0:6.1f}s  (no oracle)")
            continue
        cur = con.execute(SQL[key])
        ocols = [d[0] for d in cur.description]
        orows = cur.fetchall()
        ok = sorted(cols) == sorted(ocols) and canon(rows, cols) == canon(orows, ocols)
        bad += not ok
        print(f"{key:32s} spark rows={len(rows):6d} oracle rows={len(orows):6d} "
              f"{'OK ' if ok else 'BAD'} {t1 - t0:6.1f}s")
        if not ok:
            print("   cols", cols, ocols)
            a, b = canon(rows, cols), canon(orows, ocols)
            print("   spark-only", [r for r in a if r not in b][:5])
            print("   oracle-only", [r for r in b if r not in a][:5])
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()

"""Run every registered plan in Spark and its oracle SQL in DuckDB, compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]

Comparison: same column names (sorted), same row count, and the same
multiset of rows after sorting columns by name.  Prints one line per plan
and exits non-zero on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from reelsight.plans import PLANS  # noqa: E402
from reelsight.session import get_session  # noqa: E402
from reelsight.sources.testdata import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(PLANS)
    spark = get_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name in names:
        plan = PLANS[name]
        t0 = time.time()
        try:
            df = plan.fn(spark, sf)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if plan.oracle is None:
            print(f"ROWS {name}: {len(s_rows)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            cur = con.execute(plan.oracle)
            d_cols = [d[0] for d in cur.description]
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = canon(s_cols, s_rows)
        dc, dr = canon(d_cols, d_rows)
        if sc != dc:
            print(f"FAIL {name}: columns spark={sc} duckdb={dc}")
            bad += 1
        elif len(sr) != len(dr):
            print(f"FAIL {name}: rows spark={len(sr)} duckdb={len(dr)}")
            bad += 1
        elif sr != dr:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
            print(f"FAIL {name}: values differ, e.g. {diff}")
            bad += 1
        else:
            print(f"OK   {name}: {len(sr)} rows ({ts:.1f}s)")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

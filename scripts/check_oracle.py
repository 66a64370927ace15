"""Run registered queries on Spark and their oracle SQL on DuckDB; compare results.

Usage: python scripts/check_oracle.py [--sf-dir DIR] [name ...]
Compares row count, column names and an order-insensitive multiset of values.
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
import traceback

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))

import duckdb  # noqa: E402

from lakeloom.catalog import oracle_sql, queries  # noqa: E402
from lakeloom.session import get_session  # noqa: E402
from lakeloom.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf_dir}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    names = args.names or sorted(qs)
    bad = []
    for name in names:
        t0 = time.time()
        try:
            df = qs[name](spark, args.sf_dir)
            cols = df.columns
            rows = [tuple(norm(x) for x in r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            traceback.print_exc(limit=3)
            bad.append(name)
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"rows {name}: {len(rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sqls[name])
            ocols = [d[0] for d in cur.description]
            orows = [tuple(norm(x) for x in r) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad.append(name)
            continue
        if sorted(cols) != sorted(ocols):
            print(f"FAIL {name}: columns spark={cols} oracle={ocols}")
            bad.append(name)
            continue
        order = [ocols.index(c) for c in cols]
        orows = [tuple(r[i] for i in order) for r in orows]
        a, b = sorted(rows, key=key), sorted(orows, key=key)
        if a == b:
            print(f"ok   {name}: {len(rows)} rows {ts:.1f}s")
        else:
            print(f"FAIL {name}: spark {len(a)} rows, oracle {len(b)} rows")
            sa, sb = set(a), set(b)
            print("   only spark :", list(sa - sb)[:3])
            print("   only oracle:", list(sb - sa)[:3])
            bad.append(name)
    print("BAD:", bad)


if __name__ == "__main__":
    main()

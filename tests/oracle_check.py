"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

import math
import sys
import time

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from toksmith.session import get_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows(df):
    cols = sorted(df.columns)
    out = [tuple(norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return cols, sorted(out, key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name}: SPARK ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name}: rows={len(sdf)} (no oracle) spark={ts:.1f}s")
            continue
        t0 = time.time()
        try:
            ddf = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name}: SQL ERROR {str(e)[:400]}")
            bad += 1
            continue
        td = time.time() - t0
        c1, r1 = rows(sdf)
        c2, r2 = rows(ddf)
        ok = c1 == c2 and r1 == r2
        bad += not ok
        print(f"{name}: {'OK' if ok else 'MISMATCH'} rows={len(r1)}/{len(r2)} spark={ts:.1f}s duck={td:.1f}s")
        if not ok:
            if c1 != c2:
                print("  cols", c1, c2)
            else:
                s1, s2 = set(r1), set(r2)
                print("  spark-only", sorted(s1 - s2, key=repr)[:3])
                print("  duck-only ", sorted(s2 - s1, key=repr)[:3])
    print("bad", bad)


if __name__ == "__main__":
    main()

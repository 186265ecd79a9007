"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python tools/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and the multiset of rows (order-insensitive).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = []
    for r in df.itertuples(index=False):
        rows.append(tuple("<null>" if (v is None or (isinstance(v, float) and v != v)) else
                          (str(v) if not isinstance(v, (list, dict)) else repr(v)) for v in r))
    return sorted(rows)


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    from dockcast.plans.registry import oracle_sql, queries
    from dockcast.session import get_spark
    spark = get_spark("local[8]", 8)
    if os.environ.get("DOCKCAST_TZ"):                 # results must not depend on the session zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["DOCKCAST_TZ"])
    # DOCKCAST_STRATEGY=blocked:16 checks the skew-safe plan with tiny blocks
    strat = os.environ.get("DOCKCAST_STRATEGY")
    if strat:
        name_, _, rows_ = strat.partition(":")
        spark.conf.set("dockcast.sequence.strategy", name_)
        if rows_:
            spark.conf.set("dockcast.sequence.strategy.blockRows", rows_)
        spark.conf.set("dockcast.sequence.strategy.chunkSeconds", os.environ.get("DOCKCAST_CHUNK", "86400"))
    qs, sqls = queries(), oracle_sql()
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:28s} rows-only  rows={len(sdf)}  {ts:.1f}s")
            continue
        try:
            odf = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SQL ERROR {str(e)[:300]}")
            bad += 1
            continue
        ok_cols = sorted(sdf.columns) == sorted(odf.columns)
        ok_rows = len(sdf) == len(odf)
        ok_vals = ok_cols and ok_rows and _norm(sdf) == _norm(odf)
        status = "OK" if ok_vals else "MISMATCH"
        if not ok_vals:
            bad += 1
        print(f"{name:28s} {status:8s} rows={len(sdf)}/{len(odf)} cols={'ok' if ok_cols else (list(sdf.columns), list(odf.columns))} {ts:.1f}s")
        if ok_cols and ok_rows and not ok_vals:
            a, b = _norm(sdf), _norm(odf)
            diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
            for x, y in diffs:
                print("   spark :", x)
                print("   oracle:", y)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())

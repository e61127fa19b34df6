"""Run registered queries on Spark and their DuckDB oracle, compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Rows are compared order-insensitively after canonicalising values
(decimals -> float, timestamps -> naive, NaN -> None), with column names
sorted, which is how the correctness gate compares them.
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
import pandas as pd  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def canon(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, pd.Timestamp):
        if pd.isna(v):
            return None
        return v.tz_localize(None).to_pydatetime() if v.tzinfo else v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    if hasattr(v, "item"):
        return canon(v.item())
    if isinstance(v, bool):
        return int(v)
    return v


def rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(canon(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, sf_dir: str, names=None, verbose=True):
    from stratus.catalog import ORACLE, QUERIES
    con = duck(sf_dir)
    results = {}
    for name in names or QUERIES:
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir).toPandas()
        except Exception as e:  # report and continue
            results[name] = f"spark error: {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in ORACLE:
            results[name] = f"rows-only ({len(sdf)} rows)"
            print(name, results[name], f"{ts:.1f}s", flush=True)
            continue
        try:
            odf = con.execute(ORACLE[name]).df()
        except Exception as e:
            results[name] = f"oracle error: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        sc, sr = rows(sdf)
        oc, orr = rows(odf)
        if sc != oc:
            results[name] = f"COLUMNS differ: spark-only={set(sc) - set(oc)} oracle-only={set(oc) - set(sc)}"
        elif len(sr) != len(orr):
            results[name] = f"ROWCOUNT spark={len(sr)} oracle={len(orr)}"
        elif sr != orr:
            diff = [(a, b) for a, b in zip(sr, orr) if a != b][:2]
            results[name] = f"VALUES differ ({sum(a != b for a, b in zip(sr, orr))} rows), e.g. {diff}"
        else:
            results[name] = "ok"
        if verbose:
            print(name, results[name], f"{ts:.1f}s rows={len(sr)}", flush=True)
    return results


if __name__ == "__main__":
    from stratus.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v != "ok" and not v.startswith("rows-only")}
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; failing: {sorted(bad)}")

"""Run registered Spark queries and their DuckDB oracles side by side.

Usage: python tests/oracle_check.py [sf_dir] [name-substring ...]
"""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fraudlens.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def rows_of(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for r in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(None if (not isinstance(x, (list, tuple)) and not hasattr(x, "__len__") and pd.isna(x)) else x)
                         for x in r))
    return cols, sorted(out, key=repr)


def compare(sdf: pd.DataFrame, odf: pd.DataFrame):
    sc, sr = rows_of(sdf)
    oc, orr = rows_of(odf)
    if sc != oc:
        return f"columns differ: spark={sc} oracle={oc}"
    if len(sr) != len(orr):
        return f"row count spark={len(sr)} oracle={len(orr)}"
    bad = [(a, b) for a, b in zip(sr, orr) if a != b]
    if bad:
        return f"{len(bad)} rows differ, e.g. spark={bad[0][0]} oracle={bad[0][1]}"
    return None


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    pats = argv[2:]
    from fraudlens.session import local_session
    import __spark_entry__ as E
    spark = local_session(8)
    con = duck(sf_dir)
    qs, osql = E.queries(), E.oracle_sql()
    ok = fail = rows_only = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir).toPandas()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(ex).__name__}: {str(ex)[:400]}")
            fail += 1
            continue
        ts = time.time() - t0
        if name not in osql:
            print(f"ROWS {name}: {len(sdf)} rows ({ts:.1f}s)")
            rows_only += 1
            continue
        try:
            odf = con.execute(osql[name]).fetchdf()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {name}: oracle error {str(ex)[:400]}")
            fail += 1
            continue
        msg = compare(sdf, odf)
        dtypes = [(c, str(sdf[c].dtype), str(odf[c].dtype)) for c in sorted(sdf.columns)
                  if c in odf.columns and str(sdf[c].dtype) != str(odf[c].dtype)]
        if msg:
            print(f"FAIL {name}: {msg}")
            fail += 1
        else:
            print(f"OK   {name}: {len(sdf)} rows ({ts:.1f}s)" + (f" dtype-diff {dtypes}" if dtypes else ""))
            ok += 1
    print(f"ok={ok} fail={fail} rows_only={rows_only}")
    spark.stop()
    return fail


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)

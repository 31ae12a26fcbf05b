"""Run catalog queries in Spark and their oracle SQL in DuckDB; compare rows exactly.

Usage: python tools/oracle_check.py [--sf DIR] [query ...]
Comparison: same column names; same multiset of rows after normalising NULL/NaN,
timestamps to ISO text and numbers to repr (floats must agree bit for bit).
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from dialstat.plans.catalog import QUERIES  # noqa: E402
from dialstat.plans.oracle import ORACLE  # noqa: E402
from dialstat.session import build_session  # noqa: E402
from dialstat.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return "∅"
    try:
        import pandas as pd
        if v is pd.NaT or v is pd.NA:
            return "∅"
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
    except Exception:
        pass
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        # pandas turns nullable integer columns into floats: compare integral values as integers
        return str(int(v)) if v.is_integer() and abs(v) < 2**53 else repr(v)
    return str(v)


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "TIMESTAMP": "timestamp", "DATE": "date", "SMALLINT": "smallint",
                 "FLOAT": "float", "TINYINT": "tinyint"}


def type_diff(sdf_schema, rel):
    duck = {n: DUCK_TO_SPARK.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    spark = {f.name: f.dataType.simpleString() for f in sdf_schema.fields}
    return {n: (spark.get(n), duck.get(n)) for n in spark if spark.get(n) != duck.get(n)}


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return cols, sorted(out)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    names = a.names or list(QUERIES)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            sq = QUERIES[n](spark, a.sf)
            sdf = sq.toPandas()
            t1 = time.time()
            odf = con.execute(ORACLE[n]).df()
            tdiff = type_diff(sq.schema, con.sql(ORACLE[n]))
            sc, sr = rows_of(sdf)
            oc, orows = rows_of(odf)
            if sc != oc:
                status = f"COLUMNS differ: spark-only={sorted(set(sc)-set(oc))} oracle-only={sorted(set(oc)-set(sc))}"
            elif len(sr) != len(orows):
                status = f"ROWCOUNT {len(sr)} vs {len(orows)}"
            elif sr != orows:
                diff = [(x, y) for x, y in zip(sr, orows) if x != y][:2]
                status = f"VALUES differ, e.g. {diff}"
            elif tdiff:
                status = f"TYPES differ (spark, duckdb): {tdiff}"
            else:
                status = "ok"
        except Exception as e:  # noqa: BLE001
            status, t1 = f"ERROR {type(e).__name__}: {str(e)[:300]}", time.time()
            sr = []
        if status != "ok":
            bad += 1
        print(f"{n:28s} rows={len(sr):7d} spark={t1 - t0:6.2f}s  {status}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())

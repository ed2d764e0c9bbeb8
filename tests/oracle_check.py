"""Run registered queries in Spark and their DuckDB oracle; compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Comparison: same column names; same row count; rows equal as multisets after
normalising values (dates/timestamps to ISO text, decimals to exact text,
floats exactly and, separately, to 12 significant digits).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, loose: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if loose:
            return float(f"{v:.12g}")
        return v
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else None
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    return v


def _rows(cols, rows, loose):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], loose) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_df, con, sql: str) -> dict:
    t0 = time.time()
    s_rows = [tuple(r) for r in spark_df.collect()]
    t1 = time.time()
    s_cols = spark_df.columns
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {
        "spark_sec": round(t1 - t0, 3),
        "duck_sec": round(t2 - t1, 3),
        "rows": (len(s_rows), len(d_rows)),
        "cols_match": sorted(s_cols) == sorted(d_cols),
    }
    if not out["cols_match"]:
        out["cols"] = (sorted(set(s_cols) - set(d_cols)), sorted(set(d_cols) - set(s_cols)))
        out["ok"] = False
        return out
    exact = _rows(s_cols, s_rows, False) == _rows(d_cols, d_rows, False)
    loose_s, loose_d = _rows(s_cols, s_rows, True), _rows(d_cols, d_rows, True)
    out["exact"] = exact
    out["ok"] = exact or loose_s == loose_d
    if not out["ok"]:
        ss, dd = set(loose_s), set(loose_d)
        out["only_spark"] = list(ss - dd)[:3]
        out["only_duck"] = list(dd - ss)[:3]
        out["order"] = sorted(s_cols)
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    import __spark_entry__ as E
    from churnlab.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    qs, sql = E.queries(), E.oracle_sql()
    con = duck_connect(sf_dir)
    bad = 0
    from churnlab.plans.registry import QUERIES as registered

    for name in wanted or list(registered):
        if name not in sql:
            print(f"{name:28s} NO ORACLE")
            continue
        try:
            r = compare(qs[name](spark, sf_dir), con, sql[name])
        except Exception as exc:  # noqa: BLE001
            r = {"ok": False, "error": repr(exc)[:600]}
        bad += not r["ok"]
        print(f"{name:28s} {'OK ' if r['ok'] else 'BAD'} {r}", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

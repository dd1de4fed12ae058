"""Run registered Spark queries and their DuckDB oracle on the same parquet files and compare.

Comparison: row count, column names, and the multiset of rows (columns sorted by name, values
normalised: floats rounded to 9 significant digits, dates/timestamps as ISO text).
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = False


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if EXACT:
            return repr(v)  # full precision, keeps the sign of zero
        return float(f"{v:.9g}") + 0.0
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if hasattr(v, "as_tuple"):  # Decimal
        return float(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, names=None, verbose=True):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK_ERROR", str(e)[:300])
            if verbose:
                print(name, "SPARK_ERROR", str(e)[:300], flush=True)
            continue
        ts = time.time() - t
        if name not in sqls:
            results[name] = ("NO_ORACLE", len(s_rows))
            if verbose:
                print(f"{name:32s} no-oracle rows={len(s_rows)} {ts:.1f}s", flush=True)
            continue
        try:
            rel = con.sql(sqls[name])
            d_cols = rel.columns
            d_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("DUCK_ERROR", str(e)[:300])
            if verbose:
                print(name, "DUCK_ERROR", str(e)[:300], flush=True)
            continue
        ok_cols = sorted(s_cols) == sorted(d_cols)
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        ok = ok_cols and a == b
        results[name] = ("OK" if ok else "MISMATCH", len(s_rows), len(d_rows))
        if verbose:
            print(f"{name:32s} {'OK' if ok else 'MISMATCH'} spark={len(s_rows)} duck={len(d_rows)} {ts:.1f}s", flush=True)
            if not ok_cols:
                print("   cols spark-only", set(s_cols) - set(d_cols), "duck-only", set(d_cols) - set(s_cols))
            elif not ok:
                print("   spark-only", list((a - b).items())[:3])
                print("   duck-only ", list((b - a).items())[:3])
    return results


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from roomledger.session import local_session

    args = [a for a in sys.argv[1:] if a != "--exact"]
    EXACT = "--exact" in sys.argv
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1].split(",") if len(args) > 1 and args[1] else None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "NO_ORACLE")}
    print("FAILED:", bad if bad else "none")

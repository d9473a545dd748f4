"""Compare a registered Spark query with its DuckDB oracle, as the driver does:
row count, column names, and the multiset of rows (columns sorted by name)."""

from __future__ import annotations

import datetime as dt
import os
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def same_rows(s_cols, s_rows, o_cols, o_rows) -> str:
    """'match', or what differs."""
    if sorted(s_cols) != sorted(o_cols):
        return f"schema: spark={sorted(s_cols)} oracle={sorted(o_cols)}"
    a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
    if len(a) != len(b):
        return f"rowcount: spark={len(a)} oracle={len(b)}"
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return f"values: {diff}"
    return "match"


def compare(spark, key: str, sf_dir: str, queries, sqls, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    df = queries[key](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if key not in sqls:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sqls[key])
    o_cols = rel.columns
    o_rows = rel.fetchall()
    res["oracle_rows"] = len(o_rows)
    res["oracle_sec"] = round(time.time() - t1, 2)
    res["status"] = same_rows(s_cols, s_rows, o_cols, o_rows)
    return res


def main(argv):
    sys.path.insert(0, ".")
    from cohortkit.plans.registry import oracle_sql, queries
    from cohortkit.session import local_session

    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    keys = argv[1:]
    spark = local_session()
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for key in keys or list(qs):
        try:
            r = compare(spark, key, sf_dir, qs, sqls, con)
        except Exception as exc:  # report and continue
            r = {"key": key, "status": f"error: {type(exc).__name__}: {str(exc)[:300]}"}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))

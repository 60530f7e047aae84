"""Spark query vs DuckDB oracle: row count, column names, order-insensitive values.

Usage: python -m tests.oracle_compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}


def type_mismatches(df, con, sql) -> list[str]:
    """Columns whose Spark type does not correspond to the DuckDB result type."""
    duck = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    out = []
    for f in df.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if duck.get(f.name) != want:
            out.append(f"{f.name}: spark {f.dataType.simpleString()} vs duck {duck.get(f.name)}")
    return out


def spark_result(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duck_result(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    df = query(spark, sf_dir)
    types = type_mismatches(df, con, sql)
    s_cols, s_rows = spark_result(df)
    t1 = time.time()
    d_cols, d_rows = duck_result(con, sql)
    sc, sv = _canon(s_cols, s_rows)
    dc, dv = _canon(d_cols, d_rows)
    ok = sc == dc and len(s_rows) == len(d_rows) and sv == dv and not types
    detail = ""
    if types:
        detail = f"types {types}"
    elif sc != dc:
        detail = f"cols spark={sc} duck={dc}"
    elif len(s_rows) != len(d_rows):
        detail = f"rows spark={len(s_rows)} duck={len(d_rows)}"
    elif sv != dv:
        only_s = list((sv - dv).elements())[:3]
        only_d = list((dv - sv).elements())[:3]
        detail = f"values differ ({sum((sv - dv).values())} rows); spark-only {only_s} duck-only {only_d}"
    return ok, len(s_rows), t1 - t0, detail


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from stationlake import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_session("local[8]", 8)
    tz = os.environ.get("STATIONLAKE_SESSION_TZ")
    if tz:  # results must not depend on the session time zone
        spark.conf.set("spark.sql.session.timeZone", tz)
    con = duck_connect(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            n = df.count()
            print(f"{name:34s} rows-only  rows={n}")
            continue
        try:
            ok, n, secs, detail = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and continue with the next query
            ok, n, secs, detail = False, -1, 0.0, f"ERROR {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{name:34s} {'OK ' if ok else 'BAD'} rows={n:<7d} {secs:6.2f}s {detail}")
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

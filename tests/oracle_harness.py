"""Run a registered query in Spark and its oracle SQL in DuckDB, compare.

Mirrors the driver's gate: row count, column names, and an order-insensitive
multiset of normalised row values.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
from collections import Counter

import duckdb

VIEW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat() + " 00:00:00"
    return str(v)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in VIEW_TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = sdf.collect()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_equal": sorted(s_cols) == sorted(d_cols)}
    if not res["cols_equal"]:
        res["only_spark"] = sorted(set(s_cols) - set(d_cols))
        res["only_oracle"] = sorted(set(d_cols) - set(s_cols))
        res["values_equal"] = False
        return res
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    res["values_equal"] = sc == dc
    if not res["values_equal"]:
        diff_s = list((sc - dc).elements())[:3]
        diff_d = list((dc - sc).elements())[:3]
        res["cols"] = order
        res["spark_only_rows"] = diff_s
        res["oracle_only_rows"] = diff_d
        # per-column mismatch hint on the first pair
        if diff_s and diff_d:
            res["differing_cols"] = [c for c, a, b in zip(order, diff_s[0], diff_d[0]) if a != b]
    return res

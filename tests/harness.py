"""Run a registered query on Spark and its oracle SQL on DuckDB, compare.

Mirrors the driver's check: same column names, same row count, and the
same multiset of rows (columns sorted by name, order-insensitive).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from tickwise.sources.testdata import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None   # the driver maps NaN to NULL on both sides
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark, con, sf_dir, name, qfn, sql, show=5):
    sdf = qfn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    rel = con.sql(sql)
    dcols = rel.columns
    drows = [tuple(_norm(v) for v in r) for r in rel.fetchall()]
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows)}
    if sorted(scols) != sorted(dcols):
        out.update(ok=False, why=f"columns differ: {sorted(scols)} vs {sorted(dcols)}")
        return out
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    dorder = [dcols.index(scols[i]) for i in order]
    s = sorted((tuple(r[i] for i in order) for r in srows), key=_key)
    d = sorted((tuple(r[i] for i in dorder) for r in drows), key=_key)
    if s == d:
        out["ok"] = True
        return out
    sset, dset = {}, {}
    for r in s:
        sset[r] = sset.get(r, 0) + 1
    for r in d:
        dset[r] = dset.get(r, 0) + 1
    only_s = [r for r in sset if sset[r] != dset.get(r, 0)][:show]
    only_d = [r for r in dset if dset[r] != sset.get(r, 0)][:show]
    out.update(ok=False, why="values differ",
               cols=[scols[i] for i in order], only_spark=only_s, only_oracle=only_d,
               n_diff=sum(1 for r in sset if sset[r] != dset.get(r, 0)))
    return out

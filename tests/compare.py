"""Spark-vs-DuckDB comparison in the manner of the driver's gate:
row count, column names, order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def digest(cols: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    d_cols = [c for c in rel.columns]
    d_rows = rel.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    out["hash_match"] = out["cols_match"] and digest(s_cols, s_rows) == digest(d_cols, d_rows)
    if not out["cols_match"]:
        out["spark_cols"], out["duck_cols"] = sorted(s_cols), sorted(d_cols)
    elif not out["hash_match"]:
        so = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        do = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        sa = sorted(repr(tuple(_norm(r[i]) for i in so)) for r in s_rows)
        da = sorted(repr(tuple(_norm(r[i]) for i in do)) for r in d_rows)
        out["only_spark"] = [x for x in sa if x not in set(da)][:3]
        out["only_duck"] = [x for x in da if x not in set(sa)][:3]
    return out

"""Side-by-side check of a Spark result against DuckDB SQL on the same parquet
files: row count, column names and an order-insensitive hash of the values.
Mirrors the driver's correctness gate so it can run locally and in tests."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{v:.9g}"  # tells any two 32-bit floats apart
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
        h.update(b"\n")
    return h.hexdigest()


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    out = {
        "rows_spark": len(s_rows), "rows_oracle": len(o_rows),
        "columns_match": sorted(s_cols) == sorted(o_cols),
        "spark_columns": s_cols, "oracle_columns": o_cols,
    }
    out["rows_match"] = out["rows_spark"] == out["rows_oracle"]
    out["hash_match"] = out["columns_match"] and digest(s_cols, s_rows) == digest(o_cols, o_rows)
    if out["columns_match"] and not out["hash_match"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_o = sorted(range(len(o_cols)), key=lambda i: o_cols[i])
        ss = sorted("\x1f".join(_norm(r[i]) for i in order_s) for r in s_rows)
        oo = sorted("\x1f".join(_norm(r[i]) for i in order_o) for r in o_rows)
        only_s = sorted(set(ss) - set(oo))[:3]
        only_o = sorted(set(oo) - set(ss))[:3]
        out["sample_only_spark"] = only_s
        out["sample_only_oracle"] = only_o
    return out

"""Spark-versus-DuckDB comparison, order-insensitive, as the driver does it."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(v) for v in r) for r in pdf[cols].astype(object).itertuples(index=False, name=None)]
    return cols, sorted(out, key=repr)


def compare(spark_df, con, sql):
    s_cols, s_rows = rows_of(spark_df.toPandas())
    d_cols, d_rows = rows_of(con.sql(sql).df())
    return s_cols, d_cols, s_rows, d_rows

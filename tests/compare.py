"""Runs a query and its SQL side by side."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime64") or c in ("cuote_date", "updated"):
            df[c] = df[c].map(lambda v: None if pd.isna(v) else str(pd.Timestamp(v)))
        elif df[c].dtype.kind == "f":
            df[c] = df[c].astype("float64")
        elif df[c].dtype.kind in "iu":
            df[c] = df[c].astype("float64")
        else:
            df[c] = df[c].astype(object).where(df[c].notna(), None)
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def assert_same(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    left, right = normal(spark_df.toPandas()), normal(con.sql(sql).df())
    pd.testing.assert_frame_equal(left, right, check_exact=True)
    return len(left)

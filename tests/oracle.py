"""Compare registered queries with their SQL counterparts."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]")
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> list[str]:
    """Empty when names, row counts, dtypes and every value agree exactly."""
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} != {sorted(want.columns)}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}"]
    got, want = canonical(got), canonical(want)
    found = []
    for c in got.columns:
        if got[c].dtype != want[c].dtype:
            found.append(f"{c}: dtype {got[c].dtype} != {want[c].dtype}")
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        if not same.all():
            i = (~same).idxmax()
            found.append(f"{c}: {(~same).sum()} differ, first {got[c][i]!r} != {want[c][i]!r}")
    return found

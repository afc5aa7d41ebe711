"""Spark results against the same SQL in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in Path(directory).iterdir():
        con.execute(f"CREATE VIEW {p.name.split('.')[0]} AS SELECT * FROM '{p if p.is_file() else p / '*.parquet'}'")
    return con


def plain(df: pd.DataFrame) -> list[tuple[str, ...]]:
    def text(v) -> str:
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "NULL"
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(text(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))

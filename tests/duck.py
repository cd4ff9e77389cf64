"""Helpers to evaluate oracle SQL fragments in DuckDB over small frames."""

from __future__ import annotations

import duckdb
import pandas as pd


def run(sql: str, **frames: pd.DataFrame) -> pd.DataFrame:
    con = duckdb.connect()
    for name, frame in frames.items():
        con.register(name, frame)
    return con.execute(sql).fetchdf()


def rows(df) -> list[tuple]:
    """Sorted row tuples of a Spark or pandas frame, NaN/NaT -> None."""
    if hasattr(df, "toPandas"):
        data = [tuple(r) for r in df.collect()]
    else:
        data = [tuple(None if pd.isna(v) else v for v in r) for r in df.itertuples(index=False)]
    return sorted(data, key=lambda r: tuple((v is None, str(v)) for v in r))

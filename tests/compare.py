"""Compare a Spark result with the DuckDB result of the twin query, order-insensitively."""

from __future__ import annotations

import datetime
import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _text(value) -> str:
    if value is None or value is pd.NaT or value is pd.NA:
        return "null"
    if isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, (pd.Timestamp, datetime.datetime)):
        return value.isoformat()
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_text(v) for v in value) + "]"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    cols = sorted(frame.columns)
    return sorted(tuple(_text(v) for v in row) for row in zip(*[frame[c] for c in cols]))

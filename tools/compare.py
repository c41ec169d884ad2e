"""Side-by-side check of a registered query against its DuckDB oracle:
row count, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math

import pandas as pd

STAR_VIEWS = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in STAR_VIEWS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(value) -> str:
    if value is None or value is pd.NaT or value is pd.NA:
        return "NULL"
    if isinstance(value, float):
        if math.isnan(value):
            return "NULL"
        if value.is_integer() and abs(value) < 2**53:
            return str(int(value))
        return repr(round(value, 9))
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime().isoformat()
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if hasattr(value, "item"):  # numpy scalar
        return _norm(value.item())
    return str(value)


def frame_digest(pdf: pd.DataFrame) -> tuple[int, tuple[str, ...], str]:
    cols = tuple(sorted(pdf.columns))
    rows = sorted(
        "|".join(_norm(v) for v in rec)
        for rec in pdf[list(cols)].astype(object).itertuples(index=False, name=None)
    )
    digest = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(pdf), cols, digest


def compare(spark_df, con, sql: str) -> dict:
    got = spark_df.toPandas()
    want = con.execute(sql).fetchdf()
    g, w = frame_digest(got), frame_digest(want)
    return {
        "rows": (g[0], w[0]),
        "columns_match": g[1] == w[1],
        "spark_columns": g[1],
        "oracle_columns": w[1],
        "match": g == w,
    }

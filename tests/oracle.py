"""Run a registered query in Spark and its SQL in DuckDB and compare the results."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def tidy(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[name]) or name in ("date", "month"):
            df[name] = pd.to_datetime(df[name]).astype("datetime64[us]")
        elif df[name].dtype == object or str(df[name].dtype) in ("str", "string"):
            df[name] = df[name].astype(object).where(df[name].notna(), None)
    return df.sort_values(list(df.columns), ignore_index=True)


# DuckDB type of each Spark type.
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def difference(spark_df, db: duckdb.DuckDBPyConnection, text: str) -> str | None:
    """None if both sides agree in columns, types, row count and values."""
    want = db.sql(text)
    kinds = {name: KINDS.get(kind, kind) for name, kind in spark_df.dtypes}
    expected = dict(zip(want.columns, map(str, want.types)))
    if kinds != expected:
        return f"schema {kinds} instead of {expected}"
    a, b = tidy(spark_df.toPandas()), tidy(want.df())
    if len(a) != len(b):
        return f"{len(a)} rows instead of {len(b)}"
    try:
        pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=0, atol=1e-9)
    except AssertionError as error:
        return str(error)
    return None

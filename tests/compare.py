"""Compare a query with its SQL: columns, row count and every value, in any row order."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    rows = [
        tuple(None if pd.isna(v) else (float(v) if isinstance(v, float) else v) for v in row)
        for row in pdf.astype(object).itertuples(index=False, name=None)
    ]
    return sorted(rows, key=repr)


def normalise(pdf: pd.DataFrame) -> list[tuple]:
    """Integers and floats that came as one or the other for want of nulls compare as numbers."""
    out = []
    for row in canonical(pdf):
        out.append(tuple(repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else repr(v) for v in row))
    return sorted(out)


def difference(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} != {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return f"rows {len(spark_pdf)} != {len(sql_pdf)}"
    for ours, theirs in zip(normalise(spark_pdf), normalise(sql_pdf), strict=True):
        if ours != theirs:
            return f"first difference: {ours} != {theirs}"
    return None

"""Spark results against DuckDB's of the same tables."""

import glob
import os

import duckdb


def duck(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in glob.glob(f"{directory}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _value(v):
    if v is None or isinstance(v, float) and v != v:
        return "null"
    return f"{v:.6f}".rstrip("0").rstrip(".") if isinstance(v, float) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def same(df, con, sql) -> None:
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, got.fetchall())

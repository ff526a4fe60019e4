"""Comparison of a query with its oracle: same columns, same rows, order aside."""

from __future__ import annotations

import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for name in TABLES:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return c


def cell(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.6g}"
    if isinstance(x, (list, tuple)):
        return str([cell(y) for y in x])
    return str(x)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """'' if the rows are the same, else what differs."""
    cur = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    columns, got = rows_of(df.columns, df.collect())
    if columns != want_columns:
        return f"columns {columns} for {want_columns}"
    if got != want:
        extra, lost = [r for r in got if r not in set(want)][:3], [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows for {len(want)}; only here {extra}; only there {lost}"
    return ""

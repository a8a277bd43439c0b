"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    return str(value)


def rows_of(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_cell(row[i]) for i in order) for row in tuples)


def spark_rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [item[0] for item in cursor.description]
    return rows_of(columns, cursor.fetchall())


def difference(left, right) -> str | None:
    """None if equal, else a short account."""
    if left[0] != right[0]:
        return f"columns {sorted(set(left[0]) ^ set(right[0]))}"
    if left[1] == right[1]:
        return None
    a, b = set(left[1]), set(right[1])
    return (
        f"rows {len(left[1])} vs {len(right[1])}; only spark {sorted(a - b)[:2]}; "
        f"only duck {sorted(b - a)[:2]}"
    )

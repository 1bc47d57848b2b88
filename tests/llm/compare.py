"""Compare a query with its SQL over test tables."""

from __future__ import annotations

import duckdb


def expected(sql: str, folder: str, tables=("documents", "pages", "labels", "conversations")):
    connection = duckdb.connect()
    for table in tables:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(repr(r[i]) for i in order) for r in result.fetchall())


def found(df):
    names = sorted(df.columns)
    return names, sorted(tuple(repr(r[n]) for n in names) for r in df.collect())

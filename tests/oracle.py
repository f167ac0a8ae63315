"""Value comparison of a Spark result with a SQL result."""

from __future__ import annotations

import datetime as dt
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def compare(df, con, sql):
    names, rows = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    want_names, want_rows = rows_of([d[0] for d in result.description], result.fetchall())
    assert names == want_names
    assert len(rows) == len(want_rows), (len(rows), len(want_rows))
    for row, want in zip(rows, want_rows):
        assert row == want, (row, want)
    return len(rows)

"""Compare a registered query with its SQL on DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _rows(rows, order):
    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 9) + 0.0
        return v

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql) -> str | None:
    """None when names, types and rows agree, else what differs."""
    got_rows = df.collect()
    cursor = con.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} != {sorted(want_names)}"
    names = sorted(want_names)
    got = _rows(got_rows, [df.columns.index(n) for n in names])
    want = _rows(want_rows, [want_names.index(n) for n in names])
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{names}: {g} != {w}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    want_kinds = dict(con.execute(f"DESCRIBE {sql}").fetchall()[i][:2] for i in range(len(want_names)))
    for name, kind in df.dtypes:
        if kinds.get(kind, kind) != want_kinds[name]:
            return f"type of {name}: {kind} != {want_kinds[name]}"
    return None

"""Compare a Spark result with a DuckDB result, whatever the row order."""

from __future__ import annotations

import os

import duckdb

TABLES = ("events",)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(type_name: str) -> str:
    """One name per family for the type names of both engines."""
    return {"long": "bigint", "bigint": "bigint", "integer": "int", "int": "int",
            "string": "text", "varchar": "text", "timestamp_ntz": "timestamp",
            "timestamp": "timestamp", "date": "date", "double": "double",
            "boolean": "bool"}.get(type_name.lower(), type_name.lower())


def rows_of_spark(df):
    names = sorted(df.columns)
    kinds = {f.name: _kind(f.dataType.typeName()) for f in df.schema.fields}
    return names, kinds, sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = sorted(rel.columns)
    order = [rel.columns.index(n) for n in names]
    kinds = {n: _kind(str(t)) for n, t in zip(rel.columns, rel.types)}
    return names, kinds, sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=repr)


def difference(df, con, sql) -> str | None:
    """None if equal, else a short description."""
    names, kinds, rows = rows_of_spark(df)
    d_names, d_kinds, d_rows = rows_of_duck(con, sql)
    if names != d_names:
        return f"columns {names} != {d_names}"
    if kinds != d_kinds:
        return f"types {kinds} != {d_kinds}"
    if len(rows) != len(d_rows):
        return f"{len(rows)} rows != {len(d_rows)}"
    for mine, theirs in zip(rows, d_rows):
        if mine != theirs:
            return f"{mine} != {theirs}"
    return None

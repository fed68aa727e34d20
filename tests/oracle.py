"""Compare a Spark result with the result of its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat(" ", "microseconds")
    return value if value is None else str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def spark_table(df):
    return table_of(df.columns, [tuple(r) for r in df.collect()])


def sql_table(con, sql):
    cur = con.execute(sql)
    return table_of([d[0] for d in cur.description], cur.fetchall())


# DuckDB type name -> the Spark type it must meet
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def schemas(df, con, sql):
    ours = dict(df.dtypes)
    theirs = {r[0]: TYPES.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return ours, theirs

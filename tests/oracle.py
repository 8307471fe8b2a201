"""Compare a registered query with its SQL in DuckDB, row by row."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return value


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = rows(df.columns, df.collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = rows(columns, cursor.fetchall())
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sorted(columns)}: {got.total()} rows, {want.total()} expected; "
        f"{extra.total()} extra {list(extra)[:3]}, {missing.total()} missing {list(missing)[:3]}"
    )


# Types that hold the same values in both.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def types_differ(df, con, sql: str) -> list[str]:
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{f.name}: {f.dataType.simpleString()} is {theirs.get(f.name)}"
        for f in df.schema.fields
        if SAME_TYPE.get(f.dataType.simpleString()) != theirs.get(f.name)
    ]

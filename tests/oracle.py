"""Runs a registered query and its SQL twin, and compares the rows as multisets."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb


# DuckDB type names and the Spark types that hold the same values.
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float",
    "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    result = con.execute(sql)
    wanted_columns = [d[0] for d in result.description]
    wanted = _rows(wanted_columns, result.fetchall())
    if sorted(df.columns) != sorted(wanted_columns):
        return f"columns {sorted(df.columns)} != {sorted(wanted_columns)}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    other = {
        name: (kind, kinds[name])
        for name, kind in df.dtypes
        if TYPES.get(kinds[name], kinds[name].lower()) != kind
    }
    if other:
        return f"types {other}"
    got = _rows(df.columns, df.collect())
    if got == wanted:
        return None
    extra, lost = got - wanted, wanted - got
    return (
        f"{got.total()} rows against {wanted.total()}; "
        f"only in Spark {list(extra)[:3]}, only in SQL {list(lost)[:3]}"
    )

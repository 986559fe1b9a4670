"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations",
    "embeddings", "benchmark",
]


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(folder, t)}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


# Type names of the two engines that mean the same.
_SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def difference(df, con, sql: str) -> str | None:
    """None if the frame equals the SQL result, else what differs."""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    for name, kind in df.dtypes:
        if _SAME.get(kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(rel.columns, rel.fetchall())
    if not theirs:
        return "the SQL has no rows, so nothing was compared"
    if ours == theirs:
        return None
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(pairs)} of {len(ours)} rows differ, first: {pairs[0]}"

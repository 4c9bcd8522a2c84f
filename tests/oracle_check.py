"""Compare a Spark query with its SQL in DuckDB, value by value."""

from __future__ import annotations

import glob
import os

import duckdb


def duck(sf: str):
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    picked = [tuple(row[i] for i in order) for row in rows]
    return names, sorted(picked, key=repr)


def difference(spark, query, sql, sf, connection) -> str | None:
    """None if both give the same columns and rows, else what differs first."""
    frame = query(spark, sf)
    names, mine = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    theirs_names, theirs = canonical([d[0] for d in result.description], result.fetchall())
    if names != theirs_names:
        return f"columns {names} != {theirs_names}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{names}\n  spark {a}\n  duck  {b}"
    return None

"""Runs a registered query and its SQL on the same tables and compares them as bags of rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def oracle_connection(sf_dir: str):
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _key(row):
    return tuple((v is not None, str(type(v)) if v is None else "", v) for v in row)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=_key)


def sql_bag(connection, sql):
    cursor = connection.cursor()
    cursor.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), bag(columns, cursor.fetchall())


def spark_bag(df):
    return sorted(df.columns), bag(df.columns, [tuple(r) for r in df.collect()])


def same(a, b, tolerance=0.0):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance)
    return a == b


def differences(mine, theirs, tolerance=0.0):
    """A short description of the first differences, or an empty string."""
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows != {len(theirs[1])} rows"
    wrong = [
        (m, t) for m, t in zip(mine[1], theirs[1])
        if not all(same(a, b, tolerance) for a, b in zip(m, t))
    ]
    return f"{len(wrong)} rows differ, such as {wrong[0]}" if wrong else ""

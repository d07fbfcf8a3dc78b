"""Runs a query and its oracle and compares them cell by cell."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    # 0.0 and -0.0 are one value.
    return value + 0.0 if isinstance(value, float) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def differences(spark, con, sf_dir, query, sql, limit=5):
    """A list of texts; empty when both results are the same."""
    frame = query(spark, sf_dir)
    names, ours = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    expected_names, theirs = _rows([c[0] for c in result.description], result.fetchall())
    if names != expected_names:
        return [f"columns {names} != {expected_names}"]
    found = []
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} != {len(theirs)}")
    if not ours:
        found.append("no rows to compare")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ")
        found += [f"{a}\n    {b}" for a, b in wrong[:limit]]
    kinds = [
        (n, type(x).__name__, type(y).__name__)
        for n, x, y in zip(names, ours[0] if ours else (), theirs[0] if theirs else ())
        if x is not None and y is not None and type(x) is not type(y)
    ]
    return found + [f"type of {k}" for k in kinds]

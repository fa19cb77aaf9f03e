"""Compare a Spark result with the SQL oracle: same columns, same multiset of rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else float(value)
    return value


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(picked, key=repr)


def differences(frame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when equal; otherwise what differs."""
    relation = con.execute(sql)
    names = [c[0] for c in relation.description]
    types = {c[0]: str(c[1]) for c in relation.description}
    expected = _rows(names, relation.fetchall())
    actual = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    problems = []
    if sorted(names) != sorted(frame.columns):
        problems.append(f"columns {sorted(frame.columns)} vs {sorted(names)}")
        return problems
    kinds = {
        "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
        "boolean": {"BOOLEAN"}, "timestamp_ntz": {"TIMESTAMP"}, "date": {"DATE"},
    }
    for name, kind in frame.dtypes:
        if types[name] not in kinds.get(kind, {types[name]}):
            problems.append(f"type of {name}: {kind} vs {types[name]}")
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows vs {len(expected)}")
    bad = [(a, e) for a, e in zip(actual, expected) if repr(a) != repr(e)]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {sorted(names)} {bad[0]}")
    return problems

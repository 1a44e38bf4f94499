"""Runs a registered query on Spark and its SQL on DuckDB and compares rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return 0.0 if value == 0 else value
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(v) for v in row) for row in df.select(*names).collect())


def duck_rows(con, sql: str):
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows


SAME_TYPE = {"boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


def differences(df, con, sql: str) -> str | None:
    """None when both give the same columns, types and multiset of rows, else what differs."""
    described = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    ours_typed = {f.name: SAME_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if described != ours_typed:
        return f"types {sorted(set(ours_typed.items()) ^ set(described.items()))}"
    names, ours = spark_rows(df)
    their_names, theirs = duck_rows(con, sql)
    if names != their_names:
        return f"columns {names} != {their_names}"
    if ours != theirs:
        only_ours, only_theirs = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
        return f"{sum(ours.values())} vs {sum(theirs.values())} rows; {names}; spark {only_ours}; sql {only_theirs}"
    return None

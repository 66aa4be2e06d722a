"""Run a catalogue query and its SQL twin and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from typing import Any

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the shared tables as views."""
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value: Any) -> Any:
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> list[str]:
    """Empty when names, types and rows agree; else what differs."""
    result = connection.execute(sql)
    names = [item[0] for item in result.description]
    kinds = {item[0]: str(item[1]) for item in result.description}
    expected = result.fetchall()
    actual = [tuple(row) for row in spark_df.collect()]
    found = []
    if sorted(names) != sorted(spark_df.columns):
        found.append(f"columns {sorted(spark_df.columns)} != {sorted(names)}")
        return found
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN"}
    for name, kind in spark_df.dtypes:
        if same.get(kind) != kinds[name]:
            found.append(f"type of {name}: {kind} != {kinds[name]}")
    ours, theirs = _rows(spark_df.columns, actual), _rows(names, expected)
    if ours != theirs:
        found.append(f"{len(actual)} rows, {len(expected)} expected")
        found += [f"extra {str(row)[:400]}" for row in list((ours - theirs))[:2]]
        found += [f"lacks {str(row)[:400]}" for row in list((theirs - ours))[:2]]
    return found

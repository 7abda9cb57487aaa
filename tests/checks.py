"""Compare a Spark result with DuckDB SQL over the same Parquet files."""

from __future__ import annotations

import math
from typing import Any

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value: Any) -> Any:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def differences(found: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    expected = connection.sql(sql)
    names = sorted(found.columns)
    problems = []
    if names != sorted(expected.columns):
        return [f"columns {names} against {sorted(expected.columns)}"]
    types = dict(zip(expected.columns, (str(t) for t in expected.types)))
    for field in found.schema:
        if KINDS[field.dataType.simpleString()] != types[field.name]:
            problems.append(f"{field.name}: {field.dataType.simpleString()} against {types[field.name]}")
    order = [expected.columns.index(n) for n in names]
    theirs = sorted((tuple(plain(row[i]) for i in order) for row in expected.fetchall()), key=repr)
    ours = sorted((tuple(plain(row[n]) for n in names) for row in found.collect()), key=repr)
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows against {len(theirs)}")
    if ours != theirs:
        first = next((pair for pair in zip(ours, theirs) if pair[0] != pair[1]), None)
        problems.append(f"values differ, first {first}")
    return problems

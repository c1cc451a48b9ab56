"""Compare a query's rows with those of its SQL, whatever the order of rows and columns."""

from __future__ import annotations

import hashlib
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

FAMILIES = {
    "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "INTEGER": "int",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def fingerprint(values: tuple) -> str:
    return hashlib.md5(repr(tuple(v + 0.0 if isinstance(v, float) else v for v in values)).encode()).hexdigest()


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both agree, else what differs."""
    relation = connection.sql(sql)
    expected_types = {name: FAMILIES.get(str(kind), str(kind)) for name, kind in zip(relation.columns, relation.types)}
    actual_types = dict(df.dtypes)
    if expected_types != actual_types:
        return f"schema: expected {expected_types}, got {actual_types}"
    names = sorted(df.columns)
    order = [relation.columns.index(name) for name in names]
    expected = Counter(fingerprint(tuple(row[i] for i in order)) for row in relation.fetchall())
    actual = Counter(fingerprint(tuple(row)) for row in df.select(*[df[name] for name in names]).collect())
    if expected != actual:
        return (f"rows: expected {sum(expected.values())}, got {sum(actual.values())}, "
                f"{sum((expected - actual).values())} missing, {sum((actual - expected).values())} unexpected")
    return None

"""Compare a Spark result with SQL run on the same files."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def sql_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def row_counts(names, rows) -> Counter:
    """Rows as a multiset, with columns in order of their names."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# Spark and SQL names of the types that results may have.
SAME_TYPE = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, connection, sql: str) -> str | None:
    """What differs, or None."""
    relation = connection.sql(sql)
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    found_types = {f.name: SAME_TYPE[f.dataType.simpleString()] for f in df.schema}
    if found_types != expected_types:
        return f"schema {found_types} instead of {expected_types}"
    found = row_counts(df.columns, df.collect())
    expected = row_counts(relation.columns, relation.fetchall())
    if found != expected:
        missing, extra = expected - found, found - expected
        return f"missing {list(missing.items())[:3]}, extra {list(extra.items())[:3]}"
    return None

"""Spark rows against SQL rows: same columns, same types, same values in any order."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type -> SQL type of the same values.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def differences(spark_rows, connection, sql: str) -> list[str]:
    """Empty when both sides agree."""
    relation = connection.sql(sql)
    columns = sorted(spark_rows.columns)
    if columns != sorted(relation.columns):
        return [f"columns {columns} / {sorted(relation.columns)}"]
    found = []
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in spark_rows.dtypes:
        if SAME_TYPE.get(kind) != sql_types[name]:
            found.append(f"type of {name}: {kind} / {sql_types[name]}")
    order = [f"`{name}`" for name in columns]
    mine = Counter(tuple(map(_plain, row)) for row in spark_rows.select(*order).collect())
    places = [relation.columns.index(name) for name in columns]
    theirs = Counter(
        tuple(_plain(row[place]) for place in places) for row in relation.fetchall()
    )
    if mine.total() != theirs.total():
        found.append(f"rows {mine.total()} / {theirs.total()}")
    if mine != theirs:
        found.append(f"only Spark {list((mine - theirs).items())[:3]}")
        found.append(f"only SQL {list((theirs - mine).items())[:3]}")
    return found


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value

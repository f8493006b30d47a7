from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its own name, next to the SQL that must agree with it."""

    def add(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return without_zone(function(spark, sf_dir))

        run.__name__ = function.__name__
        run.__doc__ = function.__doc__
        _queries[function.__name__] = run
        _oracles[function.__name__] = sql
        return run

    return add


def without_zone(rows: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, the way the tables and the SQL side hold them."""
    return rows.select(
        [
            F.col(f"`{name}`").cast("timestamp_ntz").alias(name) if kind == "timestamp"
            else F.col(f"`{name}`")
            for name, kind in rows.dtypes
        ]
    )


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)

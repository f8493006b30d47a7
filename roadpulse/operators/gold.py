"""The clean table -> windowed counts and mean delays."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import tumbling

# Gold grouping column -> silver column.
GOLD_KEYS = {"type_code": "typeCode", "road": "road"}


def watermarked(rows: DataFrame, delay: str = "30 minutes", time: str = "event_ts") -> DataFrame:
    """Declare how late a row may be. Has no effect on a batch table."""
    return rows.withWatermark(time, delay)


def aggregate_windows(
    rows: DataFrame,
    window: str = "10 minutes",
    *,
    time: str = "event_ts",
    keys: Mapping[str, str] = GOLD_KEYS,
    measure: str = "delay_seconds",
) -> DataFrame:
    """Row count and mean of ``measure`` per tumbling window and key; nulls form a group.

    Both aggregates combine before the shuffle, so a task sends one row per group it met and
    a hot (window, key) group is as cheap as any other.
    """
    groups = {"span": tumbling(time, window), **{k: F.col(v) for k, v in keys.items()}}
    counted = (
        rows.where(F.col(time).isNotNull())
        .groupBy(*[column.alias(name) for name, column in groups.items()])
        .agg(F.count("*").alias("event_count"), F.avg(measure).alias("avg_delay_seconds"))
    )
    return counted.select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        *keys,
        "event_count",
        "avg_delay_seconds",
    )


def closed_only(
    windows: DataFrame,
    rows: DataFrame | None = None,
    delay: str = "30 minutes",
    time: str = "event_ts",
    *,
    latest: Column | None = None,
) -> DataFrame:
    """Windows a stream in append mode has emitted once ``rows`` have all arrived in order.

    A window is closed when its end is not after the greatest event time minus ``delay``. That
    time is read by a scalar subquery over one column of ``rows``; where reading them again is
    dear (they are parsed, not a table), give it as ``latest`` instead.
    """
    if (rows is None) == (latest is None):
        raise ValueError("give either the rows or the latest event time")
    if latest is None:
        latest = rows.select(F.max(time)).scalar()
    return windows.where(F.col("window_end") <= latest - F.expr(f"interval {delay}"))

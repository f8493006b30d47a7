"""Keep the first record of each key, on a table or on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    rows: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]
) -> DataFrame:
    """Batch form: the row that comes first by ``order`` for each key.

    Catalyst turns the ``= 1`` filter into a group limit before the shuffle, so each task
    sends at most one row per key: a key holding a third of the table costs no more to
    shuffle than any other. ``order`` must be total for the result to be unique.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def drop_seen(rows: DataFrame, key: str = "key") -> DataFrame:
    """Stream form: pass a key on the first time it is seen, and never again.

    State holds each key once and lives in the checkpoint; keep it in RocksDB, for it grows with
    the number of keys. Of copies within one micro-batch any may pass, and all are shuffled:
    reduce each micro-batch by ``first_per_key`` before, so that the first one passes and a hot
    key is a row per task.
    """
    return rows.dropDuplicates([key])


def drop_seen_within(rows: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Bounded option: a key may pass again once the watermark has moved beyond its copy.

    The event time must not be one of the keys: a copy with a new time would then pass.
    """
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])

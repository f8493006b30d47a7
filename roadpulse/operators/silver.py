"""Typed events -> the clean table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import event_date
from roadpulse.schemas import SILVER

# Silver column -> bronze column, where the names differ.
RENAMED = {"incident_id": "id", "model_id": "trafficModelId"}


def normalize(
    events: DataFrame, missing_time: str = "ingest", clock: Column | None = None
) -> DataFrame:
    """Silver columns, partition column ``event_date`` last.

    ``missing_time`` says what happens to a row without event time: ``ingest`` stamps it with
    the processing time, ``null`` leaves it, ``drop`` removes it. ``ingest`` on replayed or
    malformed data moves the watermark of the next stage to now; the other two do not.
    ``clock`` replaces the processing time.
    """
    if missing_time not in ("ingest", "null", "drop"):
        raise ValueError(f"missing_time must be ingest, null or drop, not {missing_time!r}")
    stamped = F.col("event_ts")
    if missing_time == "drop":
        events = events.where(stamped.isNotNull())
    if missing_time == "ingest":
        stamped = F.coalesce(stamped, F.current_timestamp() if clock is None else clock)
    special = {
        **{name: F.col(source) for name, source in RENAMED.items()},
        "delay_seconds": F.col("delaySeconds").cast("int"),
        "event_ts": stamped,
    }
    carried = [name for name in SILVER.names if name != "event_date"]
    return events.select(
        *[special.get(name, F.col(f"`{name}`")).alias(name) for name in carried]
    ).withColumn("event_date", event_date("event_ts"))

"""Messages -> typed events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import event_time
from roadpulse.schemas import WIRE


def parse_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Bronze columns of each message.

    A message that is not JSON stays as a row of nulls, a field of the wrong type becomes
    null, an unknown key is left out of the columns (``_raw`` still has it). Naming the mode
    keeps the optimizer from reading fewer fields for a query that needs fewer: of a message
    that breaks off, the fields before the break must not depend on which are asked for.
    """
    event = F.from_json(F.col(value).cast("string"), WIRE, {"mode": "PERMISSIVE"})
    return stamp_events(messages.select(event.alias("event")).select("event.*"))


def stamp_events(events: DataFrame) -> DataFrame:
    """Add the event time that the raw record names.

    Flat events that never went over the wire get the same bronze row as parsed ones.
    """
    return events.withColumn("event_ts", event_time("_raw"))


def is_malformed(value: Column) -> Column:
    """Whether a message is no JSON object from beginning to end.

    A message that breaks off after some fields is malformed, an object without id is not.
    """
    return F.json_object_keys(value.cast("string")).isNull()


def split_malformed(
    messages: DataFrame, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """``(readable, malformed)`` messages, each with all their columns."""
    marked = messages.withColumn("_malformed", is_malformed(F.col(value)))
    return (
        marked.where("not _malformed").drop("_malformed"),
        marked.where("_malformed").drop("_malformed"),
    )

"""Whole stages as batch plans: the same operators as the streams, for history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from roadpulse.functions import incident_key
from roadpulse.operators import (
    aggregate_windows,
    explode_snapshots,
    explode_texts,
    first_per_key,
    flatten_incidents,
    messages_of_texts,
    normalize,
    parse_events,
    stamp_events,
    with_id,
)


def new_incidents(documents: DataFrame, arrival: Sequence[str | Column]) -> DataFrame:
    """First copy of each (model, incident), by ``arrival`` of its snapshot and place in it.

    ``arrival`` must order the documents totally.
    """
    incidents = with_id(explode_snapshots(documents))
    keyed = incidents.withColumn("key", incident_key("trafficModelId", "incident.id"))
    return first_per_key(keyed, ["key"], [*arrival, "position_in_snapshot"])


def publish_batch(documents: DataFrame, arrival: Sequence[str | Column]) -> DataFrame:
    """Messages a feed would have published for ``documents``, with the JSON types they came in."""
    keyed = with_id(explode_texts(documents)).withColumn(
        "key", incident_key("trafficModelId", "incident.id")
    )
    first = first_per_key(keyed, ["key"], [*arrival, "position_in_snapshot"])
    return messages_of_texts(first)


def clean_table(
    messages: DataFrame, missing_time: str = "ingest", clock: Column | None = None
) -> DataFrame:
    """Silver rows of a topic's messages."""
    return normalize(parse_events(messages), missing_time, clock)


def gold_table(clean: DataFrame, window: str = "10 minutes") -> DataFrame:
    """Gold rows of a silver table, open windows included."""
    return aggregate_windows(clean, window)


def snapshots_to_gold(
    documents: DataFrame,
    arrival: Sequence[str | Column],
    missing_time: str = "ingest",
    clock: Column | None = None,
) -> DataFrame:
    """Every stage in one plan, without writing and reading the messages in between."""
    events = stamp_events(flatten_incidents(new_incidents(documents, arrival)))
    return gold_table(normalize(events, missing_time, clock))

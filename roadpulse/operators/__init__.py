from roadpulse.operators.bronze import is_malformed, parse_events, split_malformed, stamp_events
from roadpulse.operators.clock import ahead_of, split_ahead
from roadpulse.operators.dedup import drop_seen, drop_seen_within, first_per_key
from roadpulse.operators.gold import aggregate_windows, closed_only, watermarked
from roadpulse.operators.silver import normalize
from roadpulse.operators.snapshots import (
    explode_snapshots,
    explode_texts,
    flatten_incidents,
    incidents_per_snapshot,
    message_of_event,
    messages_of_texts,
    read_position,
    read_texts,
    to_messages,
    with_id,
)
from roadpulse.operators.spatial import (
    clustered_by_place,
    coordinates,
    key_ranges,
    place_key,
    within_bbox,
    within_bbox_clustered,
)

__all__ = [
    "aggregate_windows",
    "ahead_of",
    "closed_only",
    "clustered_by_place",
    "coordinates",
    "drop_seen",
    "drop_seen_within",
    "explode_snapshots",
    "explode_texts",
    "first_per_key",
    "flatten_incidents",
    "incidents_per_snapshot",
    "is_malformed",
    "key_ranges",
    "message_of_event",
    "messages_of_texts",
    "normalize",
    "parse_events",
    "place_key",
    "read_position",
    "read_texts",
    "split_ahead",
    "split_malformed",
    "stamp_events",
    "to_messages",
    "watermarked",
    "with_id",
    "within_bbox",
    "within_bbox_clustered",
]

from roadpulse.functions.scalars import (
    EVENT_TIME_PATTERN,
    event_date,
    event_time,
    first_label,
    incident_key,
    json_message,
    tumbling,
)

__all__ = [
    "EVENT_TIME_PATTERN",
    "event_date",
    "event_time",
    "first_label",
    "incident_key",
    "json_message",
    "tumbling",
]

"""Column expressions shared by the operators. All are built-in functions, none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how the source writes the time of an incident.
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ssX"


def incident_key(model_id: Column | str, incident_id: Column | str) -> Column:
    """SHA-256 of ``model:incident`` as hex text.

    ``concat`` and not ``concat_ws``: the colon must stay when the model id is missing.
    """
    model = F.coalesce(_col(model_id), F.lit(""))
    return F.sha2(F.concat(model, F.lit(":"), _col(incident_id)), 256)


def first_label(*columns: Column | str) -> Column:
    """The first value that is neither null nor empty; the last one is taken as it is."""
    *tried, last = [_col(column) for column in columns]
    return F.coalesce(*[F.nullif(column, F.lit("")) for column in tried], last)


def event_time(raw: Column | str, key: str = "st", pattern: str = EVENT_TIME_PATTERN) -> Column:
    """Timestamp under ``key`` of a text map; null where it is missing or does not fit.

    ``try_`` keeps one bad text from ending a stream under ANSI mode.
    """
    return F.try_to_timestamp(_col(raw)[key], F.lit(pattern))


def event_date(timestamp: Column | str) -> Column:
    """Calendar day in the session zone, which ``get_spark`` pins to UTC."""
    return F.to_date(_col(timestamp))


def json_message(*columns: Column | str) -> Column:
    """One JSON object per row; nulls are written, not left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def tumbling(timestamp: Column | str, length: str) -> Column:
    """Half-open window ``[start, end)`` aligned to the epoch."""
    return F.window(_col(timestamp), length)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column

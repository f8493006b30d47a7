"""Event times that cannot be: later than their row arrived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ahead_of(arrival: Column | str, allowance: str, time: str = "event_ts") -> Column:
    """Whether an event time is more than ``allowance`` after its row's arrival; false if one is missing."""
    arrived = F.col(arrival) if isinstance(arrival, str) else arrival
    return F.coalesce(F.col(time) > arrived + F.expr(f"interval {allowance}"), F.lit(False))


def split_ahead(
    rows: DataFrame, arrival: Column | str, allowance: str, time: str = "event_ts"
) -> tuple[DataFrame, DataFrame]:
    """Rows with a possible event time, and those whose clock was ahead.

    Apply it before the watermark is declared: that follows the greatest event time, so one row
    stamped years ahead would close every window until then, and all rows after it would be
    late. Each row is held against its own arrival, so replayed history passes, however old, and
    the answer for a row never changes.
    """
    ahead = ahead_of(arrival, allowance, time)
    return rows.where(~ahead), rows.where(ahead)

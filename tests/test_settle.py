"""Late rows, rows ahead of time and the open tail of gold."""

from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

from roadpulse import FeedConfig
from roadpulse.operators import split_ahead
from roadpulse.schemas import GOLD, SILVER
from roadpulse.sinks import backfill_table
from roadpulse.sources import read_table
from roadpulse.streaming import gold_complete, read_gold, run_stages, settle_gold

DAY = datetime.datetime(2024, 1, 10)


@pytest.fixture
def config(tmp_path):
    return FeedConfig.under(str(tmp_path))


def put(spark, config, *minutes, day=0, road="r"):
    """Clean rows at these minutes of a day, as a batch beside what the stage writes."""
    times = [(DAY + datetime.timedelta(days=day, minutes=m), road) for m in minutes]
    rows = spark.createDataFrame(times, "event_ts timestamp, road string")
    names = [f for f in SILVER if f.name not in ("event_ts", "road", "event_date", "delay_seconds")]
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in names]
    rows = rows.select("*", *missing, F.minute("event_ts").alias("delay_seconds"), F.to_date("event_ts").alias("event_date"))
    backfill_table(rows.select(SILVER.names), config.silver_table, config, partition_by=["event_date"])
    run_stages(spark, config, ["gold"], drain=True)


def counts(rows):
    """Minutes from DAY -> events; no window and group twice."""
    found = rows.collect()
    held = {(int((x.window_start - DAY).total_seconds() // 60), x.road): x.event_count for x in found}
    assert len(held) == len(found)
    return {minute: n for (minute, _), n in sorted(held.items())}


def test_settling_counts_rows_that_came_late(spark, config):
    put(spark, config, 1, 2, 15, 100)
    assert settle_gold(spark, config) == 0
    assert counts(read_gold(spark, config)) == {0: 2, 10: 1}
    put(spark, config, 3, 25, 105)
    assert counts(read_gold(spark, config)) == {0: 2, 10: 1}
    assert settle_gold(spark, config) == 1
    # The window from 20 is closed, too, but ends after the last one that the stream wrote.
    assert counts(read_gold(spark, config)) == {0: 3, 10: 1}
    assert counts(gold_complete(spark, config)) == {0: 3, 10: 1, 20: 1, 100: 2}
    assert settle_gold(spark, config) == 0
    put(spark, config, 200)
    assert settle_gold(spark, config) == 1
    assert counts(read_gold(spark, config)) == {0: 3, 10: 1, 20: 1, 100: 2}
    assert counts(gold_complete(spark, config)) == {0: 3, 10: 1, 20: 1, 100: 2, 200: 1}
    assert settle_gold(spark, config) == 0


def test_settled_days_stay_beside_later_ones(spark, config):
    put(spark, config, 1, 1439)
    put(spark, config, 0, 300, day=1)
    put(spark, config, 2, day=0)
    assert settle_gold(spark, config) == 1
    # The same day goes on after it was settled once.
    put(spark, config, 400, 600, day=1)
    put(spark, config, 1, day=1)
    assert settle_gold(spark, config) == 1
    put(spark, config, 700, day=1)
    assert settle_gold(spark, config) == 0
    want = {0: 2, 1430: 1, 1440: 2, 1740: 1, 1840: 1, 2040: 1}
    assert counts(read_gold(spark, config)) == want
    assert counts(gold_complete(spark, config)) == want | {2140: 1}


def test_groups_that_are_new_to_a_window(spark, config):
    put(spark, config, 1, 100)
    put(spark, config, 2, road=None)
    put(spark, config, 3, road="other")
    assert settle_gold(spark, config) == 1
    rows = {x.road: x.event_count for x in read_gold(spark, config).collect()}
    assert rows == {"r": 1, None: 1, "other": 1}
    assert read_gold(spark, config).columns == GOLD.names


def test_settling_before_and_without_rows(spark, config):
    run_stages(spark, config, ["gold"], drain=True)
    assert settle_gold(spark, config) == 0
    assert counts(gold_complete(spark, config)) == {}
    put(spark, config, 5)
    assert settle_gold(spark, config) == 0
    assert counts(read_gold(spark, config)) == {} and counts(gold_complete(spark, config)) == {0: 1}


def test_settling_that_stopped_half_way_is_taken_up(spark, config, monkeypatch):
    from roadpulse.streaming import settle

    put(spark, config, 1, 100)
    put(spark, config, 2)
    monkeypatch.setattr(settle, "_write_days", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        settle_gold(spark, config)
    monkeypatch.undo()
    assert settle_gold(spark, config) == 1
    assert counts(read_gold(spark, config)) == {0: 2}
    assert settle_gold(spark, config) == 0
    assert len(os.listdir(config.touched_path)) == 1


def test_one_future_stamp_does_not_close_the_days_before_it(spark, config):
    put(spark, config, 1, 60, 90_000_000)
    put(spark, config, 5, 300, day=2)
    assert counts(read_table(spark, config.gold_table, GOLD, config)) == {0: 1, 60: 1, 2880: 1}
    assert settle_gold(spark, config) == 0
    assert max(counts(gold_complete(spark, config))) == 2880 + 300
    run_stages(spark, config, ["ahead"], drain=True)
    assert read_table(spark, config.ahead_table, SILVER, config).count() == 1


def test_the_guard_can_be_turned_off(spark, config):
    put(spark, config.with_(max_ahead=None), 1, 60, 90_000_000)
    put(spark, config.with_(max_ahead=None), 5, day=2)
    assert counts(read_table(spark, config.gold_table, GOLD, config)) == {0: 1, 60: 1}


def test_rows_are_split_by_their_own_arrival(spark):
    rows = spark.createDataFrame(
        [(1, DAY, DAY), (2, DAY + datetime.timedelta(hours=2), DAY), (3, None, DAY), (4, DAY, None),
         (5, DAY + datetime.timedelta(hours=1), DAY), (6, DAY - datetime.timedelta(days=900), DAY)],
        "id long, event_ts timestamp, came timestamp",
    )
    good, ahead = split_ahead(rows, "came", "1 hour")
    assert [x.id for x in ahead.collect()] == [2]
    assert sorted(x.id for x in good.collect()) == [1, 3, 4, 5, 6]

"""Emit, late-drop, dedup and restart rules, with the batch boundaries pinned."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import incident_key
from roadpulse.operators import aggregate_windows, drop_seen, drop_seen_within, watermarked
from roadpulse.session import ROCKSDB_SETTINGS, settings

CLEAN = "typeCode string, road string, delay_seconds int, event_ts timestamp"


class Feed:
    """A landing folder and a query over it that survives restarts."""

    def __init__(self, spark, folder, schema, build, one_file_per_batch=False):
        self.spark, self.schema, self.build = spark, schema, build
        self.landed, self.table, self.checkpoint = (
            str(folder / name) for name in ("landed", "table", "checkpoint")
        )
        os.makedirs(self.landed)
        self.reader = {"maxFilesPerTrigger": "1"} if one_file_per_batch else {}
        self.seen = []

    def land(self, *rows):
        """One file; its time differs from that of every other file."""
        frame = self.spark.createDataFrame([tuple(row) for row in rows], self._text_schema())
        typed = frame.select(
            [F.col(f.name).cast(f.dataType) for f in self._schema().fields]
        ).coalesce(1)
        typed.write.mode("append").parquet(self.landed)
        time.sleep(0.02)

    def run(self, available_now=True):
        source = (
            self.spark.readStream.schema(self.schema).options(**self.reader).parquet(self.landed)
        )
        query = (
            self.build(source)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start(self.table)
        )
        query.awaitTermination()
        self.progress = query.recentProgress
        return query

    def rows(self):
        return [tuple(r) for r in self.spark.read.parquet(self.table).collect()]

    def new_rows(self):
        """Rows written since the last call."""
        now = self.rows()
        fresh = list(now)
        for row in self.seen:
            fresh.remove(row)
        self.seen = now
        return sorted(fresh, key=str)

    def _schema(self):
        return self.spark.createDataFrame([], self.schema).schema

    def _text_schema(self):
        """Timestamps are given as text, so that no machine zone gets in."""
        types = {f.name: f.dataType.simpleString() for f in self._schema().fields}
        return ", ".join(
            f"`{name}` {'string' if kind == 'timestamp' else kind}" for name, kind in types.items()
        )


def at(clock, day="2024-01-01"):
    return f"{day} {clock}" if clock else None


def gold(rows):
    return aggregate_windows(watermarked(rows)).select(
        F.date_format("window_start", "HH:mm"),
        "type_code",
        "road",
        "event_count",
        "avg_delay_seconds",
    ).toDF("start", "type_code", "road", "n", "mean")


def test_windows_open_close_and_late_rows(spark, tmp_path):
    feed = Feed(spark, tmp_path, CLEAN, gold)
    feed.land(
        ("8", "r1", 10, at("00:01:00")),
        ("8", "r1", None, at("00:09:59")),
        ("8", None, 4, at("00:02:00")),
        (None, None, 6, at("00:02:00")),
        ("8", "r1", 7, at("00:10:00")),
        ("8", "r1", 7, None),
    )
    feed.run()
    assert feed.new_rows() == []

    # The watermark reaches 00:10: equality closes the first window.
    feed.land(("8", "r1", 1, at("00:40:00")))
    feed.run()
    assert feed.new_rows() == sorted(
        [
            ("00:00", "8", "r1", 2, 10.0),
            ("00:00", "8", None, 1, 4.0),
            ("00:00", None, None, 1, 6.0),
        ],
        key=str,
    )

    # Too late for a closed window; in time for an open one.
    feed.land(("8", "r1", 99, at("00:05:00")), ("8", "r1", 3, at("00:10:01")))
    feed.run()
    assert feed.new_rows() == []

    feed.land(("8", "r1", 1, at("00:45:00")))
    feed.run()
    # Older than the watermark, but its window is still open.
    feed.land(("8", "r1", 100, at("00:11:00")))
    feed.run()
    assert feed.new_rows() == []

    feed.land(("8", "r1", 1, at("01:00:00")))
    feed.run()
    assert feed.new_rows() == [("00:10", "8", "r1", 3, pytest.approx(110 / 3))]

    # Windows 00:40 and 01:00 stay open until newer rows come.
    feed.run()
    assert feed.new_rows() == []


def test_nothing_is_late_within_one_batch(spark, tmp_path):
    feed = Feed(spark, tmp_path, CLEAN, gold)
    feed.land(
        ("8", "r1", 10, at("00:01:00")),
        ("8", "r1", 1, at("00:40:00")),
        ("8", "r1", 99, at("00:05:00")),
    )
    feed.run()
    assert feed.rows() == [("00:00", "8", "r1", 2, 54.5)]


def test_drop_rule_lags_the_emit_rule_by_one_batch(spark, tmp_path):
    feed = Feed(spark, tmp_path, CLEAN, gold, one_file_per_batch=True)
    pairs = [("00:01", "00:40"), ("00:05", "00:41"), ("00:06", "00:42"), ("00:07", "00:43")]
    for early, late in pairs:
        feed.land(("8", "r1", 1, at(early + ":00")), ("8", "r1", 1, at(late + ":00")))
    feed.run()
    assert feed.rows() == [("00:00", "8", "r1", 2, 1.0)]


def test_one_future_row_closes_everything(spark, tmp_path):
    feed = Feed(spark, tmp_path, CLEAN, gold)
    feed.land(("8", "r1", 1, at("00:00:00")), ("8", "r1", 1, at("00:00:00", "2099-01-01")))
    feed.run()
    feed.new_rows()
    feed.land(("8", "r1", 1, at("01:00:00")))
    feed.run()
    assert feed.new_rows() == []
    dropped = [s["numRowsDroppedByWatermark"] for p in feed.progress for s in p["stateOperators"]]
    assert sum(dropped) == 1


def test_dropped_rows_are_counted_as_groups(spark, tmp_path):
    feed = Feed(spark, tmp_path, CLEAN, gold)
    feed.land(("8", "r1", 1, at("02:00:00")))
    feed.run()
    feed.land(*[("8", "r1", 1, at(clock)) for clock in ("00:01:00", "00:02:00", "00:15:00")])
    feed.run()
    dropped = [s["numRowsDroppedByWatermark"] for p in feed.progress for s in p["stateOperators"]]
    assert sum(dropped) == 2


@pytest.mark.parametrize(
    "clock, start",
    [
        ("2024-01-01 00:09:59.999999", "2024-01-01 00:00:00"),
        ("2024-01-01 00:10:00", "2024-01-01 00:10:00"),
        ("1969-12-31 23:59:59", "1969-12-31 23:50:00"),
        ("1970-01-01 00:00:00", "1970-01-01 00:00:00"),
    ],
)
def test_windows_are_half_open_and_aligned_to_the_epoch(spark, clock, start):
    rows = spark.createDataFrame([(clock,)], "t string").select(
        F.lit("8").alias("typeCode"),
        F.lit("r").alias("road"),
        F.lit(1).alias("delay_seconds"),
        F.col("t").cast("timestamp").alias("event_ts"),
    )
    found = aggregate_windows(rows).select(F.col("window_start").cast("string")).first()[0]
    assert found == start


def test_mean_of_missing_delays_is_missing(spark):
    rows = spark.createDataFrame([("8", "r", None, None), ("8", "r", None, None)], CLEAN)
    rows = rows.withColumn("event_ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    row = aggregate_windows(rows).first()
    assert (row.event_count, row.avg_delay_seconds) == (2, None)


def test_restart_reads_nothing_twice(spark, tmp_path):
    feed = Feed(spark, tmp_path, CLEAN, gold)
    feed.land(("8", "r1", 1, at("00:01:00")), ("8", "r1", 1, at("02:00:00")))
    feed.run()
    first = feed.rows()
    feed.run()
    assert feed.rows() == first
    assert sum(p["numInputRows"] for p in feed.progress) == 0


def test_window_state_survives_a_restart(spark, tmp_path):
    feed = Feed(spark, tmp_path, CLEAN, gold)
    feed.land(("8", "r1", 10, at("00:01:00")))
    feed.run()
    feed.land(("8", "r1", 20, at("00:02:00")))
    feed.run()
    feed.land(("8", "r1", 0, at("00:40:00")))
    feed.run()
    assert feed.rows() == [("00:00", "8", "r1", 2, 15.0)]


SIGHTING = "model string, id string, value int, seen timestamp, origin string"
BATCHES = [
    [("m1", "a", 1, "00:00"), ("m1", "b", 1, "00:01"), ("m1", "a", 9, "00:02")],
    [("m1", "a", 5, "00:03"), ("m2", "a", 5, "00:03"), ("m1", "z", 1, "03:00")],
    [("m1", "a", 7, "03:01")],
]


def run_dedup(spark, folder, operator):
    def build(rows):
        return operator(rows.withColumn("key", incident_key("model", "id")))

    feed = Feed(spark, folder, SIGHTING, build)
    for number, batch in enumerate(BATCHES):
        feed.land(*[(m, i, v, at(t + ":00"), f"file-{number}") for m, i, v, t in batch])
        feed.run()
    return sorted(f"{r[0]}{r[1]}{r[2]}" for r in feed.rows())


def test_first_sighting_passes_once(spark, tmp_path):
    assert run_dedup(spark, tmp_path, drop_seen) == ["m1a1", "m1b1", "m1z1", "m2a5"]


def test_bounded_dedup_forgets_after_the_delay(spark, tmp_path):
    found = run_dedup(spark, tmp_path, lambda r: drop_seen_within(r, "key", "seen", "30 minutes"))
    assert found == ["m1a1", "m1a7", "m1b1", "m1z1", "m2a5"]


def test_rocksdb_state_gives_the_same_rows(spark, tmp_path):
    with settings(spark, ROCKSDB_SETTINGS):
        assert run_dedup(spark, tmp_path, drop_seen) == ["m1a1", "m1b1", "m1z1", "m2a5"]


def test_settings_are_put_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), settings(spark, ROCKSDB_SETTINGS):
        assert spark.conf.get(name).endswith("RocksDBStateStoreProvider")
        1 / 0
    assert spark.conf.get(name) == before

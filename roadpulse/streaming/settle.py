"""Rows that a gold stream could not count: found, counted, and put in place of what it wrote.

A stream in append mode writes a window once. Rows that come after that, late or by backfill, are
dropped by it. ``settle_gold`` follows the clean table like a stage of its own: of the rows that came
since its last run it keeps the windows they touch, compares the counts of closed ones with gold's,
and computes the days of those that differ anew from the clean table. A day replaces its
predecessor as one partition; ``read_gold`` puts these days in place of what the stream wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import sources
from roadpulse.config import FeedConfig
from roadpulse.functions import event_date, tumbling
from roadpulse.operators import aggregate_windows
from roadpulse.schemas import GOLD, SILVER
from roadpulse.session import require_shared
from roadpulse.sinks import ensure_dir
from roadpulse.sources.readers import exists, has_files, remove, subfolders
from roadpulse.streaming.stages import in_time_rows

TOUCHED = "window_start timestamp"
NEW, PENDING = "new-", "pending-"


def closed_until(spark: SparkSession, config: FeedConfig) -> DataFrame:
    """One row: the end of the last window that the stream has written, null before the first.

    No window that ends later is written, and none that ends sooner will be.
    """
    written = sources.read_table(spark, config.gold_table, GOLD, config)
    return written.agg(F.max("window_end").alias("closed_until"))


def _last_end(spark: SparkSession, config: FeedConfig):
    if not exists(spark, config.gold_table):
        return None
    return closed_until(spark, config).first()[0]


def _clean(spark: SparkSession, config: FeedConfig) -> DataFrame:
    """The clean table, without rows whose clock was ahead, with the day of their window."""
    rows = in_time_rows(sources.read_table(spark, config.silver_table, SILVER, config, arrived=True), config)
    return rows.where("event_ts is not null").withColumn("_window", tumbling("event_ts", config.window))


def _settled(spark: SparkSession, config: FeedConfig) -> DataFrame | None:
    if not has_files(spark, config.settled_table):
        return None
    if config.table_format == "delta":
        return spark.read.format("delta").load(config.settled_table).select(GOLD.names)
    return spark.read.schema(GOLD).parquet(config.settled_table).select(GOLD.names)


def read_gold(spark: SparkSession, config: FeedConfig) -> DataFrame:
    """The windowed table, with settled windows in place of those that the stream wrote."""
    written = sources.read_table(spark, config.gold_table, GOLD, config)
    settled = _settled(spark, config)
    if settled is None:
        return written
    replaced = settled.select("window_start").distinct()
    return written.join(replaced, "window_start", "left_anti").select(GOLD.names).union(settled)


def gold_complete(spark: SparkSession, config: FeedConfig) -> DataFrame:
    """``read_gold`` and the windows that are still open, computed from the clean table.

    A window ends either by the last one that the stream has written, or after it; so none is
    there twice. The open tail reads the days from then on only.
    """
    clean = _clean(spark, config)
    last = _last_end(spark, config)
    if last is None:
        return aggregate_windows(clean, config.window)
    after = F.lit(last)
    tail = clean.where((F.col("_window.end") > after) & (F.col("event_date") >= F.to_date(after - F.expr(f"interval {config.window}"))))
    return read_gold(spark, config).union(aggregate_windows(tail, config.window))


def settle_gold(spark: SparkSession, config: FeedConfig) -> int:
    """Count what the gold stream dropped; returns the number of days that were written anew.

    Run it after the gold stage has read what is there (``run_stages(..., drain=True)``), from one
    place at a time. It may stop anywhere: what it has not settled is looked at again. A touched
    window that is still open is kept until it is closed, and one that was closed is compared once
    more at the next run, so that rows which the stage had not read yet are not missed.

    The driver holds the list of days that differ, one value a day.
    """
    require_shared(spark, config.locations)
    ensure_dir(spark, config.touched_path)
    before = [x for x in subfolders(spark, config.touched_path) if x.startswith(PENDING)]
    _collect_touched(spark, config)
    fresh = [x for x in subfolders(spark, config.touched_path) if x.startswith(NEW)]
    last = _last_end(spark, config)
    if last is None or not before + fresh:
        return 0

    def read(names: list[str]) -> DataFrame:
        paths = [f"{config.touched_path}/{name}" for name in names]
        return spark.read.schema(TOUCHED).parquet(*paths) if paths else spark.createDataFrame([], TOUCHED)

    closed = F.col("window_start") + F.expr(f"interval {config.window}") <= F.lit(last)
    touched = read(before + fresh).distinct()
    days = _days_that_differ(spark, config, touched.where(closed))
    if days:
        _write_days(spark, config, days, last)
    again = read(before).where(~closed).union(read(fresh)).distinct()
    again.write.parquet(f"{config.touched_path}/{PENDING}{uuid.uuid4().hex}")
    for name in before + fresh:
        remove(spark, f"{config.touched_path}/{name}")
    return len(days)


def _collect_touched(spark: SparkSession, config: FeedConfig) -> None:
    """The windows of rows that came since the last run, a folder per micro-batch."""
    rows = sources.stream_table(spark, config.silver_table, SILVER, config, arrived=True)
    windows = in_time_rows(rows, config).select(tumbling("event_ts", config.window)["start"].alias("window_start"))

    def keep(batch: DataFrame, number: int) -> None:
        place = f"{config.touched_path}/{NEW}{number:012d}"
        batch.where("window_start is not null").distinct().write.mode("overwrite").parquet(place)

    query = (
        windows.writeStream.foreachBatch(keep)
        .option("checkpointLocation", config.settle_checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _days_that_differ(spark: SparkSession, config: FeedConfig, windows: DataFrame) -> list:
    """Days of those windows whose rows gold does not all count.

    A missed row makes a count smaller, never larger, so counts alone tell. Of the clean table only
    the days of the windows are read, and only their event times.
    """
    touched_days = windows.select(event_date("window_start").alias("day")).distinct()
    found = [x.day for x in touched_days.collect()]
    if not found:
        return []
    clean = _clean(spark, config).where(F.col("event_date").isin(found)).select(F.col("_window.start").alias("window_start"))
    there = clean.join(windows, "window_start", "left_semi").groupBy("window_start").agg(F.count("*").alias("n"))
    counted = read_gold(spark, config).groupBy("window_start").agg(F.sum("event_count").alias("counted"))
    differ = there.join(counted, "window_start", "left").where(F.col("n") != F.coalesce("counted", F.lit(0)))
    return [x.day for x in differ.select(event_date("window_start").alias("day")).distinct().collect()]


def _write_days(spark: SparkSession, config: FeedConfig, days: list, last) -> None:
    """Closed windows of whole days, each day one partition that replaces the one before."""
    clean = _clean(spark, config)
    rows = clean.where(F.col("event_date").isin(days) & (F.col("_window.end") <= F.lit(last)))
    windows = aggregate_windows(rows, config.window).withColumn("day", event_date("window_start"))
    (
        windows.write.format(config.table_format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .save(config.settled_table)
    )

"""The streaming queries. Each ``*_rows`` builds the rows of a stage from its source rows and
each ``start_*`` connects it to the configured source and sink."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from roadpulse import sinks, sources
from roadpulse.config import FeedConfig
from roadpulse.functions import incident_key
from roadpulse.operators import (
    aggregate_windows,
    drop_seen,
    drop_seen_within,
    explode_texts,
    first_per_key,
    messages_of_texts,
    normalize,
    parse_events,
    read_position,
    split_ahead,
    split_malformed,
    watermarked,
    with_id,
    within_bbox,
)
from roadpulse.schemas import BRONZE, SILVER
from roadpulse.session import DEDUP_SETTINGS, settings
from roadpulse.sources.readers import ARRIVAL, ARRIVED, SNAPSHOT_ORDER, exists, remove, subfolders


BATCH = "batch-"
#: Keys seen under another checkpoint; goes before the first batch.
SEEDS = f"{BATCH}-seeds"
#: For how long, by their times, the second step remembers files that it has taken. Only the folder
#: of one batch is ever left to take, and it is the newest.
FOLDER_AGE = "7d"


def incident_rows(documents: DataFrame, config: FeedConfig) -> DataFrame:
    """Snapshot documents, as ``stream_snapshots`` gives them -> one row per incident with an id.

    An incident stays the text it came as until repeats are dropped; only its id is read. The progress of the query reports the snapshots
    read, how many of them are no JSON object, and the incidents in them, repeats included. The
    box is applied first: the feed would not have sent what lies outside.
    """
    unreadable = F.json_object_keys("payload").isNull()
    polled = documents.observe(
        "polled", F.count("*").alias("snapshots"), F.count_if(unreadable).alias("unreadable")
    )
    incidents = explode_texts(polled)
    if config.apply_bbox:
        placed = incidents.withColumn("_p", read_position("text"))
        inside = within_bbox(placed, config.bbox, "_p", config.lon_key, config.lat_key)
        incidents = inside.drop("_p")
    counted = incidents.observe("exploded", F.count("*").alias("incidents"))
    return with_id(counted).select(
        *SNAPSHOT_ORDER,
        "position_in_snapshot",
        "trafficModelId",
        "text",
        F.unhex(incident_key("trafficModelId", "incident.id")).alias("key"),
    )


def message_rows(first: DataFrame, config: FeedConfig) -> DataFrame:
    """First copies, one micro-batch of them at a time -> one message per new incident."""
    if config.dedup_bound:
        fresh = drop_seen_within(first, "key", ARRIVAL, config.dedup_bound)
    else:
        fresh = drop_seen(first)
    # Keys that were taken over from another checkpoint have no text.
    fresh = fresh.where("text is not null")
    return messages_of_texts(fresh)


def bronze_rows(messages: DataFrame, config: FeedConfig | None = None) -> DataFrame:
    if config is not None and config.quarantine:
        messages, _ = split_malformed(messages)
    return parse_events(messages)


def silver_rows(events: DataFrame, config: FeedConfig) -> DataFrame:
    return normalize(events, config.missing_time)


def in_time_rows(clean: DataFrame, config: FeedConfig) -> DataFrame:
    """Rows of the clean table, read with their arrival, that may count."""
    if config.max_ahead is None:
        return clean
    return split_ahead(clean, ARRIVED, config.max_ahead)[0]


def gold_rows(clean: DataFrame, config: FeedConfig) -> DataFrame:
    return aggregate_windows(watermarked(clean, config.watermark), config.window)


def start_first_copies(
    rows: DataFrame,
    order: Sequence[Column],
    folder: str,
    checkpoint: str,
    send: Callable[[DataFrame], StreamingQuery],
    config: FeedConfig,
    trigger: Mapping[str, str | bool],
    stage: str | None = None,
) -> StreamingQuery:
    """Keep the first copy of each ``key`` of a stream, by micro-batch and then by ``order``.

    Two steps. This query reduces each micro-batch to one row per key (each task does before the
    shuffle, so a hot key is a row per task) and writes these to a folder of the batch's number.
    ``send`` gets them as a stream, starts a query over it that keeps the keys it has seen and
    ends with what is there, and is waited for; so it takes one folder as one micro-batch.

    A batch that is tried again finds its folder complete, or writes it anew before the second
    query has looked, and that one's checkpoint knows which files it has taken. So nothing is
    lost, repeated or out of order, whichever of the two stops where. Only the last batch can be
    tried again, so once it is taken the folders before it go: two are there at most.
    """
    shape = rows.schema

    def reduce_and_send(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        place = f"{folder}/{BATCH}{number:012d}"
        if not exists(session, f"{place}/_SUCCESS"):
            first_per_key(batch, ["key"], order).write.mode("overwrite").parquet(place)
        with settings(session, DEDUP_SETTINGS):
            query = send(first_copies(session, folder, shape))
        try:
            query.awaitTermination()
        finally:
            query.stop()
        if (error := query.exception()) is not None:
            raise error
        for name in subfolders(session, folder):
            if name.startswith(BATCH) and name < f"{BATCH}{number:012d}":
                remove(session, f"{folder}/{name}")

    writer = rows.writeStream.foreachBatch(reduce_and_send).option("checkpointLocation", checkpoint)
    return sinks.named_stage(writer, stage).trigger(**trigger).start()


def first_copies(spark: SparkSession, folder: str, shape: StructType) -> DataFrame:
    """What the first step has written, as a stream."""
    reader = spark.readStream.schema(shape)
    return reader.options(maxFileAge=FOLDER_AGE, recursiveFileLookup="true").parquet(folder)


def send_first_copies(first: DataFrame, config: FeedConfig) -> StreamingQuery:
    """Send those of them whose key was not seen before, and end."""
    place = f"{config.publish_checkpoint.rstrip('/')}/sent"
    with settings(first.sparkSession, DEDUP_SETTINGS):
        writer = sinks.message_writer(message_rows(first, config), place, config, available_now=True)
        return writer.start()


def start_publish(
    spark: SparkSession, config: FeedConfig, available_now: bool = False
) -> StreamingQuery:
    """Send each incident once, the first copy of it.

    Lines of one file that carry no ``poll_key`` share their place in the order of snapshots;
    their text decides, so that a retry finds the same rows.
    """
    base = config.publish_checkpoint.rstrip("/")
    return start_first_copies(
        incident_rows(sources.stream_snapshots(spark, config), config),
        [
            *[F.col(name).asc_nulls_last() for name in SNAPSHOT_ORDER],
            F.col("position_in_snapshot"),
            F.col("text"),
        ],
        config.first_copies_path,
        f"{base}/poll",
        lambda first: send_first_copies(first, config),
        config,
        sinks.trigger_options(config.poll_seconds, available_now),
        "publish",
    )


def start_bronze(
    spark: SparkSession, config: FeedConfig, available_now: bool = False
) -> StreamingQuery:
    events = bronze_rows(sources.stream_messages(spark, config), config)
    return sinks.table_writer(
        events, config.bronze_checkpoint, config, available_now=available_now, stage="bronze"
    ).start(config.bronze_table)


def start_quarantine(
    spark: SparkSession, config: FeedConfig, available_now: bool = False
) -> StreamingQuery:
    """Collect the text of unreadable messages, in a table with the column ``value``."""
    _, malformed = split_malformed(sources.stream_messages(spark, config))
    texts = malformed.select(F.col("value").cast("string").alias("value"))
    return sinks.table_writer(
        texts, config.quarantine_checkpoint, config, available_now=available_now, stage="quarantine"
    ).start(config.quarantine_table)


def start_silver(
    spark: SparkSession, config: FeedConfig, available_now: bool = False
) -> StreamingQuery:
    """Write clean rows by day. The rows of a day come together first, so that a micro-batch adds few
    files per day, however many tasks read it: in tasks of the advisory size, of which one day that
    holds most rows fills several, or in ``silver_buckets`` tasks a day if that is set."""
    events = sources.stream_table(spark, config.bronze_table, BRONZE, config)
    rows = silver_rows(events, config)
    if config.silver_buckets is None:
        rows = rows.hint("rebalance", F.col("event_date"))
    else:
        bucket = F.pmod(F.xxhash64("incident_id"), F.lit(config.silver_buckets))
        rows = rows.repartition("event_date", bucket)
    return sinks.table_writer(
        rows,
        config.silver_checkpoint,
        config,
        partition_by=["event_date"],
        available_now=available_now,
        stage="silver",
    ).start(config.silver_table)


def start_gold(
    spark: SparkSession, config: FeedConfig, available_now: bool = False
) -> StreamingQuery:
    """Write windows once they are closed. Rows whose clock was ahead do not count: see ``max_ahead``."""
    clean = sources.stream_table(spark, config.silver_table, SILVER, config, arrived=True)
    return sinks.table_writer(
        gold_rows(in_time_rows(clean, config), config),
        config.gold_checkpoint,
        config,
        available_now=available_now,
        stage="gold",
    ).start(config.gold_table)


def start_ahead(
    spark: SparkSession, config: FeedConfig, available_now: bool = False
) -> StreamingQuery:
    """Collect the clean rows that gold leaves out, whose event time is later than can be."""
    clean = sources.stream_table(spark, config.silver_table, SILVER, config, arrived=True)
    _, ahead = split_ahead(clean, ARRIVED, config.max_ahead or "1000 years")
    return sinks.table_writer(
        ahead.drop(ARRIVED), config.ahead_checkpoint, config, available_now=available_now, stage="ahead"
    ).start(config.ahead_table)


def start_tail(spark: SparkSession, config: FeedConfig) -> StreamingQuery:
    """Print the first ``tail_rows`` parsed messages of each micro-batch as they arrive."""
    rows = bronze_rows(sources.stream_messages(spark, config))
    return sinks.console_writer(rows, config.tail_rows).start()

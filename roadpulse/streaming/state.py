"""The keys that publish has seen, as a table: to look at, and to take into another checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import sources
from roadpulse.config import FeedConfig
from roadpulse.session import require_shared
from roadpulse.sinks import ensure_dir
from roadpulse.sources.readers import exists
from roadpulse.streaming.stages import SEEDS, first_copies, incident_rows, send_first_copies


def seen_keys(spark: SparkSession, config: FeedConfig) -> DataFrame:
    """(key, partition): keys of the incidents that publish remembers, and where its state has them.

    Read from the last committed micro-batch of the checkpoint, by the tasks of a batch query.
    """
    state = spark.read.format("statestore").load(f"{config.publish_checkpoint.rstrip('/')}/sent")
    return state.select(F.col("key.key").alias("key"), F.col("partition_id").cast("int").alias("partition"))


def state_partitions(spark: SparkSession, config: FeedConfig) -> DataFrame:
    """(partition, keys): how evenly the state is spread."""
    return seen_keys(spark, config).groupBy("partition").agg(F.count("*").alias("keys"))


def reseed_publish(spark: SparkSession, old: FeedConfig, new: FeedConfig) -> None:
    """Let publish start anew under the checkpoint of ``new`` with all keys that it has seen under ``old``.

    The first run of a stateful query fixes its shuffle width for ever. This takes the keys out of the
    old state and through the dedup of a new checkpoint, whose width is the session's as it is now;
    none of them is sent. The old stage must have stopped, the new one must not have run. Where the
    keys are bounded in time (``dedup_bound``) the state holds more than keys, and this refuses.
    """
    if old.dedup_bound or new.dedup_bound:
        raise ValueError("keys that are forgotten after a time cannot be taken into another checkpoint")
    require_shared(spark, new.locations)
    if exists(spark, f"{new.publish_checkpoint.rstrip('/')}/sent"):
        raise ValueError(f"{new.publish_checkpoint} has seen incidents already")
    ensure_dir(spark, new.first_copies_path)
    shape = incident_rows(sources.stream_snapshots(spark, old), old).schema
    empty = {x.name: F.lit(None).cast(x.dataType).alias(x.name) for x in shape}
    seeds = seen_keys(spark, old).select(*[F.col("key") if name == "key" else empty[name] for name in shape.names])
    seeds.write.mode("overwrite").parquet(f"{new.first_copies_path}/{SEEDS}")
    query = send_first_copies(first_copies(spark, new.first_copies_path, shape), new)
    query.awaitTermination()

"""Where rows go: the message topic, the stage tables, the console."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from roadpulse.config import FeedConfig
from roadpulse.sources.readers import backfill_path, exists, has_files

# Fixed value: where a file stream keeps the list of the files it has written.
SINK_LOG = "_spark_metadata"


def has_sink_log(spark: SparkSession, path: str) -> bool:
    """Whether a stream has written to a folder, so that readers see its files only."""
    return exists(spark, f"{path.rstrip('/')}/{SINK_LOG}")


def refuse_batch_into_stream(spark: SparkSession, path: str) -> None:
    if has_sink_log(spark, path):
        raise ValueError(
            f"a stream writes {path}, and readers would not see a batch put there; "
            "use backfill_table, or land the rows where the stream reads"
        )


def refuse_stream_into_batch(spark: SparkSession, path: str) -> None:
    if has_files(spark, path) and not has_sink_log(spark, path):
        raise ValueError(
            f"{path} holds files of a batch, which readers would not see once a stream writes "
            "there; move them, or put them there by backfill_table"
        )


def trigger_options(seconds: int | None, available_now: bool = False) -> dict:
    """Keyword arguments of ``DataStreamWriter.trigger``."""
    if available_now:
        return {"availableNow": True}
    return {"processingTime": f"{seconds or 0} seconds"}


def named_stage(writer: DataStreamWriter, stage: str | None) -> DataStreamWriter:
    """Name a query after its stage and this run: names of running queries must differ."""
    return writer.queryName(f"{stage}.{uuid.uuid4().hex[:12]}") if stage else writer


def table_writer(
    rows: DataFrame,
    checkpoint: str,
    config: FeedConfig,
    *,
    partition_by: Sequence[str] = (),
    available_now: bool = False,
    stage: str | None = None,
) -> DataStreamWriter:
    """Append to a stage table. Offsets, state and the list of written files share the
    checkpoint, so that a restart neither repeats nor loses a micro-batch."""
    writer = (
        rows.writeStream.format(config.table_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(config.trigger_seconds, available_now))
    )
    writer = named_stage(writer, stage)
    return writer.partitionBy(*partition_by) if partition_by else writer


def message_writer(
    messages: DataFrame, checkpoint: str, config: FeedConfig, *, available_now: bool = False
) -> DataStreamWriter:
    """Publish ``value`` texts to the topic, or with the file transport one per line."""
    writer = (
        messages.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(config.poll_seconds, available_now))
    )
    if config.transport == "kafka":
        return writer.format("kafka").options(**kafka_sink_options(config))
    return writer.format("text").option("path", config.wire_path)


def console_writer(rows: DataFrame, shown: int) -> DataStreamWriter:
    """Print the first ``shown`` rows of each micro-batch and how many more it has.

    Only those rows come to the driver. For looking, so it has no checkpoint.
    """

    def show(batch: DataFrame, number: int) -> None:
        total = batch.count()
        if total:
            print(f"batch {number}: {total} rows, {max(total - shown, 0)} of them not shown")
            batch.show(shown, truncate=False)

    return rows.writeStream.foreachBatch(show).outputMode("append")


def kafka_sink_options(config: FeedConfig) -> dict[str, str]:
    return {"kafka.bootstrap.servers": config.kafka_bootstrap, "topic": config.kafka_topic}


def write_messages(messages: DataFrame, config: FeedConfig) -> None:
    """Batch form of ``message_writer``."""
    if config.transport == "kafka":
        messages.write.format("kafka").options(**kafka_sink_options(config)).save()
    else:
        refuse_batch_into_stream(messages.sparkSession, config.wire_path)
        messages.write.mode("append").text(config.wire_path)


def write_table(
    rows: DataFrame,
    path: str,
    config: FeedConfig,
    *,
    partition_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Append a batch to a stage table.

    Rows are rebalanced by the partition columns first: each folder gets few files of the
    advisory size instead of one per task, and AQE splits a day that holds most of the rows
    over several tasks. ``rebalance=False`` saves that shuffle where the rows already come
    in order of the partition columns.
    """
    if config.table_format == "parquet":
        refuse_batch_into_stream(rows.sparkSession, path)
    _append(rows, path, config, partition_by, rebalance)


def backfill_table(
    rows: DataFrame,
    path: str,
    config: FeedConfig,
    *,
    partition_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Append a batch to a stage table that a stream writes too.

    The rows go to a folder beside it, which ``read_table`` and the next stage read as part of
    the table. A Delta table takes both kinds of writes itself.
    """
    place = path if config.table_format == "delta" else backfill_path(path)
    _append(rows, place, config, partition_by, rebalance)


def _append(
    rows: DataFrame, path: str, config: FeedConfig, partition_by: Sequence[str], rebalance: bool
) -> None:
    if partition_by and rebalance:
        rows = rows.hint("rebalance", *[F.col(name) for name in partition_by])
    writer = rows.write.format(config.table_format).mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create a folder on whatever file system it names; a stream needs its source to exist."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def ensure_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    config: FeedConfig,
    *,
    partition_by: Sequence[str] = (),
) -> None:
    """Make a stage table that the next stage can start to read before it has rows."""
    if config.table_format == "parquet":
        ensure_dir(spark, path)
        ensure_dir(spark, backfill_path(path))
        return
    empty = spark.createDataFrame([], schema).write.format(config.table_format).mode("ignore")
    (empty.partitionBy(*partition_by) if partition_by else empty).save(path)

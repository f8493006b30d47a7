"""Where rows come from: landed snapshots, the message topic, and the stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadpulse.config import FeedConfig

# Columns that say when and where from a snapshot came; together they order the snapshots.
POLLED = "polled"
ARRIVAL = "arrival"
ORIGIN = "origin"
ORIGIN_START = "origin_start"
#: When the file of a row was written: a row of a stage table has no later arrival.
ARRIVED = "_arrived"
SNAPSHOT_ORDER = (POLLED, ARRIVAL, ORIGIN, ORIGIN_START)


def kafka_options(config: FeedConfig) -> dict[str, str]:
    """Options of the topic scan.

    ``starting_offsets`` only counts for a query without a checkpoint; later starts resume from
    theirs. With ``fail_on_data_loss`` a query ends where the topic has dropped messages that
    it has not read; without, it goes on with what is left.
    """
    options = {
        "kafka.bootstrap.servers": config.kafka_bootstrap,
        "subscribe": config.kafka_topic,
        "startingOffsets": config.starting_offsets,
        "failOnDataLoss": str(config.fail_on_data_loss).lower(),
    }
    if config.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(config.max_offsets_per_trigger)
    if config.min_topic_splits:
        options["minPartitions"] = str(config.min_topic_splits)
    return options


def file_options(config: FeedConfig) -> dict[str, str]:
    """How much a file stream reads in one micro-batch, and how old a file may be.

    Left to itself Spark skips, without a word, files a week older than the newest one it has
    seen: a copy or a sync that keeps times, or a late upload, would be lost.
    """
    options = {"maxFileAge": config.max_file_age}
    if config.max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(config.max_files_per_trigger)
    if config.max_bytes_per_trigger:
        options["maxBytesPerTrigger"] = config.max_bytes_per_trigger
    return options


def landed_options(config: FeedConfig) -> dict[str, str]:
    """The same for folders that others land files in: read files can be moved away."""
    options = file_options(config)
    if config.archive_path:
        options |= {"cleanSource": "archive", "sourceArchiveDir": config.archive_path}
    return options


def stream_messages(spark: SparkSession, config: FeedConfig) -> DataFrame:
    """The topic, or with the file transport one message per line; ``value`` is binary."""
    if config.transport == "kafka":
        return spark.readStream.format("kafka").options(**kafka_options(config)).load()
    lines = spark.readStream.options(**landed_options(config)).text(config.wire_path)
    return lines.select(F.col("value").cast("binary").alias("value"))


def read_messages(spark: SparkSession, config: FeedConfig) -> DataFrame:
    """Batch form of ``stream_messages`` for a backfill; all that the topic holds, not its tail."""
    if config.transport == "kafka":
        options = {**kafka_options(config), "startingOffsets": "earliest"}
        options.pop("maxOffsetsPerTrigger", None)
        return spark.read.format("kafka").options(**options).load()
    return spark.read.text(config.wire_path).select(
        F.col("value").cast("binary").alias("value")
    )


def stream_snapshots(spark: SparkSession, config: FeedConfig) -> DataFrame:
    """Landed snapshot documents: ``payload``, and the columns of ``SNAPSHOT_ORDER``."""
    reader = spark.readStream.options(**landed_options(config))
    return _documents(reader.text(config.snapshot_path, wholetext=config.whole_files), config)


def read_snapshots(spark: SparkSession, config: FeedConfig) -> DataFrame:
    lines = spark.read.text(config.snapshot_path, wholetext=config.whole_files)
    return _documents(lines, config)


def _documents(lines: DataFrame, config: FeedConfig) -> DataFrame:
    polled = F.lit(None).cast("bigint")
    if config.poll_key:
        polled = F.get_json_object("value", f"$.{config.poll_key}").try_cast("bigint")
    return lines.select(
        polled.alias(POLLED),
        F.col("_metadata.file_modification_time").alias(ARRIVAL),
        F.col("_metadata.file_path").alias(ORIGIN),
        F.col("_metadata.file_block_start").alias(ORIGIN_START),
        F.col("value").alias("payload"),
    )


def backfill_path(path: str) -> str:
    """Where batches for a Parquet stage table go that a stream writes.

    Readers of a folder that a stream writes take the stream's own log as the list of its files,
    so a file put there by anyone else is never seen.
    """
    return f"{path.rstrip('/')}_backfill"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there and holds anything."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(folder) and len(files.listStatus(folder)) > 0


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in files.listStatus(folder) if x.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _arrived(rows: DataFrame, arrived: bool) -> DataFrame:
    return rows.withColumn(ARRIVED, F.col("_metadata.file_modification_time")) if arrived else rows


def stream_table(
    spark: SparkSession, path: str, schema: StructType, config: FeedConfig, *, arrived: bool = False
) -> DataFrame:
    """A stage table as a stream, with what was backfilled beside it. Delta brings its schema.

    ``arrived`` adds the column ARRIVED.
    """
    reader = spark.readStream.options(**file_options(config))
    if config.table_format == "delta":
        return _arrived(reader.format("delta").load(path), arrived)
    rows = _arrived(reader.schema(schema).parquet(path), arrived)
    return rows.unionByName(_arrived(reader.schema(schema).parquet(backfill_path(path)), arrived))


def read_table(
    spark: SparkSession, path: str, schema: StructType, config: FeedConfig, *, arrived: bool = False
) -> DataFrame:
    if config.table_format == "delta":
        return _arrived(spark.read.format("delta").load(path), arrived)
    rows = _arrived(spark.read.schema(schema).parquet(path), arrived)
    if has_files(spark, backfill_path(path)):
        more = spark.read.schema(schema).parquet(backfill_path(path))
        rows = rows.unionByName(_arrived(more, arrived))
    return rows

"""The operators as streaming queries, run until they have read all of their input.

Everything a query writes goes below one fresh folder in the shared root. Rows and files are
written and read by Spark tasks; the driver only starts the queries. Where the state grows with
the number of keys it is kept in RocksDB, off the heap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.catalog import sql
from roadpulse.catalog.registry import query
from roadpulse.config import FeedConfig
from roadpulse.functions import incident_key
from roadpulse.operators import (
    aggregate_windows,
    drop_seen,
    drop_seen_within,
    normalize,
    parse_events,
    watermarked,
)
from roadpulse.plans.derived import (
    bronze_like,
    read_events,
    silver_like,
    snapshot_documents,
    stream_events,
    wire_messages,
)
from roadpulse.schemas import BRONZE, GOLD, SILVER
from roadpulse.session import NO_DATA_BATCHES, new_work_dir, settings
from roadpulse.sinks import (
    backfill_table,
    ensure_dir,
    table_writer,
    trigger_options,
    write_messages,
)
from roadpulse.sources import read_messages, read_table
from roadpulse.streaming import (
    gold_complete,
    hold,
    read_gold,
    read_progress,
    reseed_publish,
    run_stages,
    seen_keys,
    settle_gold,
    start_first_copies,
    start_stages,
    stop_all,
)


def _config(spark: SparkSession, purpose: str, **overrides) -> FeedConfig:
    return FeedConfig.under(new_work_dir(spark, purpose), **overrides)


def _drain(rows: DataFrame, path: str, checkpoint: str, config: FeedConfig, **options) -> None:
    table_writer(rows, checkpoint, config, available_now=True, **options).start(
        path
    ).awaitTermination()


@query(
    f"""
    with {sql.GOLD}
    select * from gold
    where window_end <= (select max(event_ts) - interval 30 minute from incidents)
    """
)
def gold_10m_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed gold table: watermark, window, append; open windows stay unwritten."""
    config = _config(spark, "gold_10m_stream")
    clean = silver_like(stream_events(spark, sf_dir))
    windows = aggregate_windows(watermarked(clean, config.watermark), config.window)
    _drain(windows, config.gold_table, config.gold_checkpoint, config)
    return read_table(spark, config.gold_table, GOLD, config)


@query(
    f"""
    with {sql.EVENT_COLUMNS}
    select cast(event_id as varchar) as incident_id, model as model_id, event_type as type_code,
           road, delay_seconds, area_hint, date_trunc('second', ts) as event_ts,
           cast(ts as date) as event_date, cast(user_id as double) as lon, value as lat
    from incident_columns
    """
)
def bronze_silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message stream -> bronze table -> silver table, one stream per hop."""
    config = _config(spark, "bronze_silver_stream")
    bronze = parse_events(wire_messages(stream_events(spark, sf_dir)))
    _drain(bronze, config.bronze_table, config.bronze_checkpoint, config)
    events = spark.readStream.schema(BRONZE).parquet(config.bronze_table)
    _drain(
        normalize(events, config.missing_time),
        config.silver_table,
        config.silver_checkpoint,
        config,
        partition_by=["event_date"],
    )
    return read_table(spark, config.silver_table, SILVER, config).select(
        "incident_id",
        "model_id",
        F.col("typeCode").alias("type_code"),
        "road",
        "delay_seconds",
        "area_hint",
        "event_ts",
        "event_date",
        F.col("position")["x"].try_cast("double").alias("lon"),
        F.col("position")["y"].try_cast("double").alias("lat"),
    )


def _first_copies(
    rows: DataFrame,
    config: FeedConfig,
    seen: Callable[[DataFrame], DataFrame] = drop_seen,
) -> DataFrame:
    """Run rows (key, event_id, ...) through the dedup of the publish stage, by event_id."""

    def send(first: DataFrame) -> StreamingQuery:
        writer = table_writer(seen(first), config.bronze_checkpoint, config, available_now=True)
        return writer.start(config.bronze_table)

    spark = rows.sparkSession
    ensure_dir(spark, config.first_copies_path)
    query = start_first_copies(
        rows,
        [F.col("event_id")],
        config.first_copies_path,
        config.publish_checkpoint,
        send,
        config,
        trigger_options(None, available_now=True),
    )
    query.awaitTermination()
    return spark.read.parquet(config.bronze_table)


@query(
    """
    select event_type as model_id, cast(user_id as varchar) as id,
           sha256(event_type || ':' || user_id) as key, min(event_id) as event_id
    from events group by all
    """
)
def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key passes once, its first copy, with its state in the checkpoint."""
    rows = stream_events(spark, sf_dir).select(
        "event_id",
        F.col("event_type").alias("model_id"),
        F.col("user_id").cast("string").alias("id"),
        incident_key("event_type", F.col("user_id").cast("string")).alias("key"),
    )
    found = _first_copies(rows, _config(spark, "dedup_stream"))
    return found.select("model_id", "id", "key", "event_id")


@query(
    """
    select event_type, min(event_id) as event_id, arg_min(value, event_id) as value
    from events group by 1
    """
)
def dedup_stream_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where a handful of keys hold the whole table: a row per key and task moves."""
    rows = stream_events(spark, sf_dir).select(
        "event_id", F.col("event_type").alias("key"), "event_type", "value"
    )
    found = _first_copies(rows, _config(spark, "dedup_stream_hot_keys"))
    return found.select("event_type", "event_id", "value")


@query(
    """
    select event_type, user_id, min(event_id) as event_id from events group by 1, 2
    """
)
def dedup_stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounded form: a key may pass again a year of event time after its copy, so once here."""
    rows = stream_events(spark, sf_dir).select(
        "event_id", "event_ts", "event_type", "user_id", F.concat_ws(":", "event_type", "user_id").alias("key")
    )
    found = _first_copies(
        rows,
        _config(spark, "dedup_stream_bounded"),
        lambda first: drop_seen_within(first, "key", "event_ts", "365 days"),
    )
    return found.select("event_type", "user_id", "event_id")


@query(
    f"""
    with {sql.EXPLODED}
    select model as model_id, id, ty as type_code, ic as icon_code, d as description, c as comment,
           f as from_street, t as to_street, r as road, dl as delay_seconds,
           coalesce(nullif(r, ''), nullif(f, ''), t) as area_hint, st, lon, lat
    from exploded where id <> ''
    qualify row_number() over (partition by model, id order by event_id, pos) = 1
    """
)
def publish_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed snapshots published as messages, each incident once, the first copy of it."""
    config = _config(spark, "publish_stream", whole_files=False, poll_key="polled")
    _land_snapshots(read_events(spark, sf_dir), config)
    run_stages(spark, config, ["publish"], drain=True)
    return parse_events(read_messages(spark, config)).select(
        F.col("trafficModelId").alias("model_id"),
        "id",
        F.col("typeCode").alias("type_code"),
        F.col("iconCode").alias("icon_code"),
        "description",
        "comment",
        F.col("from").alias("from_street"),
        F.col("to").alias("to_street"),
        "road",
        F.col("delaySeconds").alias("delay_seconds"),
        "area_hint",
        F.col("_raw")["st"].alias("st"),
        F.col("position")["x"].try_cast("double").alias("lon"),
        F.col("position")["y"].try_cast("double").alias("lat"),
    )


def _land_snapshots(events: DataFrame, config: FeedConfig) -> None:
    """Documents in several files, in no order: copies of an incident lie in different ones.

    The events are spread, not the documents, which are many times wider; and over all cores.
    """
    width = max(8, events.sparkSession.sparkContext.defaultParallelism)
    documents = snapshot_documents(events.repartition(width, "event_id"))
    documents.write.text(config.snapshot_path)


@query(
    f"""
    with {sql.GOLD_OF_MESSAGES}
    select * from gold
    where window_end <= (select max(event_ts) - interval 30 minute from incidents)
    """
)
def medallion_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed messages through bronze, silver and gold, each stage a stream over a table."""
    config = _config(spark, "medallion_chain")
    messages = wire_messages(read_events(spark, sf_dir))
    write_messages(messages.select(F.col("value").cast("string").alias("value")), config)
    run_stages(spark, config, ["bronze", "silver", "gold"], drain=True)
    return read_table(spark, config.gold_table, GOLD, config)


@query(
    f"""
    with {sql.GOLD_OF_MESSAGES}
    select * from gold
    where window_end <= (select max(event_ts) - interval 30 minute from incidents)
    """
)
def running_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stages running side by side, held until each has caught up, then stopped."""
    config = _config(spark, "running_chain", trigger_seconds=0)
    messages = wire_messages(read_events(spark, sf_dir))
    write_messages(messages.select(F.col("value").cast("string").alias("value")), config)
    running = start_stages(spark, config, ["bronze", "silver", "gold"])
    try:
        for _, query in running:
            query.processAllAvailable()
        hold(running, 0)
    finally:
        stop_all(running)
    return read_table(spark, config.gold_table, GOLD, config)


@query(
    f"""
    with {sql.EXPLODED},
    {sql.gold_of('''
        select strptime(st, '%Y-%m-%dT%H:%M:%SZ') as event_ts, ty as type_code, r as road,
               dl as delay_seconds
        from exploded where id <> '' and st is not null
        qualify row_number() over (partition by model, id order by event_id, pos) = 1
    ''')}
    select * from gold
    where window_end <= (select max(event_ts) - interval 30 minute from incidents)
    """
)
def feed_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed snapshots through all four stages; incidents without time are left out."""
    config = _config(
        spark, "feed_chain", whole_files=False, poll_key="polled", missing_time="drop"
    )
    _land_snapshots(read_events(spark, sf_dir), config)
    run_stages(spark, config, drain=True)
    return read_table(spark, config.gold_table, GOLD, config)


@query(
    f"""
    with {sql.LATE_BATCHES},
    late as (select b, lag(wk) over (order by b) as late_wm from watermark),
    kept as (select batched.* from batched join late using (b)
             where late_wm is null or w + interval 10 minute > late_wm)
    select w as window_start, event_type, count(*) as n from kept
    where w + interval 10 minute <= (select max(ts) - interval 30 minute from batched)
    group by 1, 2
    """
)
def late_drop_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows over six back-to-back batches: the drop rule lags the emit rule by one."""
    return _late_drop(spark, sf_dir, "late_drop_stream", idle_between=False)


@query(
    f"""
    with {sql.LATE_BATCHES},
    kept as (select batched.* from batched join watermark using (b)
             where wk is null or w + interval 10 minute > wk)
    select w as window_start, event_type, count(*) as n from kept
    where w + interval 10 minute <= (select max(ts) - interval 30 minute from batched)
    group by 1, 2
    """
)
def late_drop_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with an idle moment after each batch, in which the drop rule catches up."""
    return _late_drop(spark, sf_dir, "late_drop_settled", idle_between=True)


BATCHES = 6


def _late_drop(
    spark: SparkSession, sf_dir: str, purpose: str, idle_between: bool
) -> DataFrame:
    """Let six batches arrive one after the other at a query that stops and restarts.

    A restart per batch pins the batch boundaries whatever the number or size of the files.
    """
    config = _config(spark, purpose)
    staged, landed = f"{config.bronze_table}_staged", config.silver_table
    late = F.when(F.col("event_id") % 50 == 0, F.col("event_id") % 3 + 1).otherwise(0)
    block = F.least(F.lit(BATCHES - 1), F.floor((F.dayofmonth("event_ts") - 1) / 5) + late)
    (
        read_events(spark, sf_dir)
        .select("event_ts", F.col("event_type"), F.col("value"), block.cast("int").alias("b"))
        .write.partitionBy("b")
        .parquet(staged)
    )
    batches = spark.read.parquet(staged)
    arriving = batches.drop("b").schema
    for number in range(BATCHES):
        batches.where(F.col("b") == number).drop("b").write.mode("append").parquet(landed)
        rows = watermarked(spark.readStream.schema(arriving).parquet(landed), config.watermark)
        windows = aggregate_windows(
            rows, config.window, keys={"event_type": "event_type"}, measure="value"
        )
        no_data = str(idle_between or number == BATCHES - 1).lower()
        with settings(spark, {NO_DATA_BATCHES: no_data}):
            _drain(windows, config.gold_table, config.gold_checkpoint, config)
    return spark.read.parquet(config.gold_table).select(
        "window_start", "event_type", F.col("event_count").alias("n")
    )


@query(
    f"""
    with {sql.EVENT_COLUMNS}
    select cast(event_id as varchar) as incident_id, date_trunc('second', ts) as event_ts
    from incident_columns
    """
)
def late_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose files are a month older than what has been read already are read all the same."""
    config = _config(spark, "late_landing")
    messages = wire_messages(read_events(spark, sf_dir), "event_id")
    texts = messages.select("event_id", F.col("value").cast("string").alias("value"))
    texts.where("event_id % 3 <> 0").select("value").write.text(config.wire_path)
    run_stages(spark, config, ["bronze", "silver"], drain=True)
    late = f"{config.bronze_path}_late"
    texts.where("event_id % 3 = 0").select("value").write.text(late)
    _age_and_move(spark, late, config.wire_path, days=30)
    run_stages(spark, config, ["bronze", "silver"], drain=True)
    rows = read_table(spark, config.silver_table, SILVER, config)
    return rows.select("incident_id", "event_ts")


def _age_and_move(spark: SparkSession, source: str, target: str, days: int) -> None:
    """Land the files of a folder in another one, their times set back."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path(source)):
        name = status.getPath().getName()
        if name.startswith("part-"):
            files.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)
            files.rename(status.getPath(), path(f"{target}/late-{name}"))


@query(
    f"""
    with {sql.GOLD_OF_MESSAGES}
    select * from gold
    where window_end <= (select max(event_ts) - interval 30 minute from incidents)
    """
)
def backfill_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the messages streamed to bronze, half of the rows backfilled beside them."""
    config = _config(spark, "backfill_then_stream")
    events = read_events(spark, sf_dir)
    old = parse_events(wire_messages(events.where("event_id % 2 = 0")))
    backfill_table(old, config.bronze_table, config)
    new = wire_messages(events.where("event_id % 2 = 1"))
    write_messages(new.select(F.col("value").cast("string").alias("value")), config)
    run_stages(spark, config, ["bronze", "silver", "gold"], drain=True)
    return read_table(spark, config.gold_table, GOLD, config)


@query(
    """
    select event_id % 10 = 0 as without_time, count(*) as n,
           event_id % 10 = 0 as stamped_while_running
    from events group by event_id % 10 = 0
    """
)
def ingest_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without event time are stamped with the processing time, one instant per micro-batch."""
    config = _config(spark, "ingest_clock")
    before = spark.sql("select current_timestamp()").first()[0]
    rows = bronze_like(stream_events(spark, sf_dir)).drop("event_id")
    _drain(normalize(rows, "ingest"), config.silver_table, config.silver_checkpoint, config)
    after = spark.sql("select current_timestamp()").first()[0]
    clean = read_table(spark, config.silver_table, SILVER, config)
    without = F.col("incident_id").cast("bigint") % 10 == 0
    inside = F.col("event_ts").between(F.lit(before), F.lit(after))
    return clean.groupBy(without.alias("without_time")).agg(
        F.count("*").alias("n"), F.every(inside).alias("stamped_while_running")
    )


def _land_messages(spark: SparkSession, events: DataFrame, config: FeedConfig) -> None:
    write_messages(wire_messages(events).select(F.col("value").cast("string").alias("value")), config)


@query(
    f"""
    with {sql.EVENT_COLUMNS},
    {sql.gold_of('''
        select date_trunc('second', ts) as event_ts, event_type as type_code, road, delay_seconds
        from incident_columns where event_id % 997 <> 0
    ''')}
    select * from gold
    where window_end <= (select max(event_ts) - interval 30 minute from incidents)
    """
)
def future_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stamped in 2199 arrive among the first half of the events; the second half still counts."""
    config = _config(spark, "future_stamps")
    _run_with_ahead(spark, sf_dir, config, ["bronze", "silver", "gold"])
    return read_table(spark, config.gold_table, GOLD, config)


@query("select event_type as type_code, count(*) as n from events where event_id % 997 = 0 group by 1")
def future_rows_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those rows are in a table of their own."""
    config = _config(spark, "future_rows_apart")
    _run_with_ahead(spark, sf_dir, config, ["bronze", "silver", "ahead"])
    rows = read_table(spark, config.ahead_table, SILVER, config)
    return rows.groupBy(F.col("typeCode").alias("type_code")).agg(F.count("*").alias("n"))


def _run_with_ahead(spark: SparkSession, sf_dir: str, config: FeedConfig, stages: list[str]) -> None:
    ahead = F.lit("2199-01-01T00:00:00Z").cast("timestamp")
    events = read_events(spark, sf_dir)
    stamped = events.withColumn("event_ts", F.when(F.col("event_id") % 997 == 0, ahead).otherwise(F.col("event_ts")))
    early = F.dayofmonth("ts") <= 15
    for part in (early, ~early):
        _land_messages(spark, stamped.where(part), config)
        run_stages(spark, config, stages, drain=True)


@query(
    f"""
    with {sql.GOLD_OF_MESSAGES}
    select * from gold
    where window_end <= (select max(event_ts) - interval 30 minute from incidents)
    """
)
def backfill_after_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the first ten days come when gold is done with them; their days are settled."""
    return read_gold(spark, _settled_backfill(spark, sf_dir, "backfill_after_gold"))


@query(f"with {sql.GOLD_OF_MESSAGES} select * from gold")
def gold_with_open_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows from the table, settled ones among them, open ones from the clean rows."""
    return gold_complete(spark, _settled_backfill(spark, sf_dir, "gold_with_open_tail"))


def _settled_backfill(spark: SparkSession, sf_dir: str, purpose: str) -> FeedConfig:
    config = _config(spark, purpose)
    events = read_events(spark, sf_dir)
    late = (F.col("event_id") % 5 == 0) & (F.dayofmonth("ts") <= 10)
    _land_messages(spark, events.where(~late), config)
    run_stages(spark, config, ["bronze", "silver", "gold"], drain=True)
    settle_gold(spark, config)
    rows = normalize(parse_events(wire_messages(events.where(late))))
    backfill_table(rows, config.silver_table, config, partition_by=["event_date"])
    run_stages(spark, config, ["gold"], drain=True)
    settle_gold(spark, config)
    return config


@query(
    f"""
    with {sql.DOCUMENTS}
    select 'publish' as stage, count(*) as snapshots, cast(sum((event_id % 19 = 0)::int) as bigint) as unreadable,
           cast(sum(case when readable then 4 else 0 end) as bigint) as incidents
    from documents_of_events
    """
)
def polls_logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What publish reports of its polls, added up from the table of reports."""
    config = _config(spark, "polls_logged", whole_files=False, poll_key="polled", max_files_per_trigger=3)
    _land_snapshots(read_events(spark, sf_dir), config)
    run_stages(spark, config, ["publish"], drain=True)
    counts = F.col("counts")
    return read_progress(spark, config).groupBy("stage").agg(
        F.sum(counts["polled.snapshots"]).alias("snapshots"),
        F.sum(counts["polled.unreadable"]).alias("unreadable"),
        F.sum(counts["exploded.incidents"]).alias("incidents"),
    )


@query(
    f"""
    with {sql.EXPLODED}
    select distinct sha256(coalesce(model, '') || ':' || id) as key from exploded where id <> ''
    """
)
def seen_keys_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys in the state of publish are those of the incidents it has sent."""
    config = _config(spark, "seen_keys_read", whole_files=False, poll_key="polled")
    _land_snapshots(read_events(spark, sf_dir), config)
    run_stages(spark, config, ["publish"], drain=True)
    return seen_keys(spark, config).select(F.lower(F.hex("key")).alias("key"))


@query(
    f"""
    with {sql.EXPLODED}
    select distinct model as model_id, id from exploded where id <> ''
    """
)
def publish_reseeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the snapshots published, then all of them under another width and the keys of before."""
    old = _config(spark, "publish_reseeded", whole_files=False, poll_key="polled")
    width = "spark.sql.shuffle.partitions"
    events = read_events(spark, sf_dir)
    _land_snapshots(events.where("event_id % 2 = 0"), old)
    run_stages(spark, old, ["publish"], drain=True)
    new = _config(spark, "publish_reseeded", whole_files=False, poll_key="polled")
    with settings(spark, {width: str(int(spark.conf.get(width)) + 3)}):
        reseed_publish(spark, old, new)
    _land_snapshots(events, new)
    run_stages(spark, new, ["publish"], drain=True)
    sent = read_messages(spark, old).unionByName(read_messages(spark, new))
    return parse_events(sent).select(F.col("trafficModelId").alias("model_id"), "id")

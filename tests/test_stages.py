"""Sources, sinks and the four stages together."""

from __future__ import annotations

import json
import os
import time

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from roadpulse import FeedConfig, sinks, sources
from roadpulse.config import parse_bbox
from roadpulse.schemas import BRONZE, GOLD, SILVER
from roadpulse.session import DELTA_SETTINGS, new_work_dir, settings, shared_root
from roadpulse.streaming import (
    bronze_rows,
    hold,
    run_stages,
    start_publish,
    start_stages,
    start_tail,
    stop_all,
)


def incident(number, clock, **more):
    plain = {"id": number, "ty": 8, "r": "r1", "dl": 60, "st": f"2024-01-01T{clock}:00Z"}
    return {**plain, **more}


def land(config, name, *incidents, model="m"):
    """A snapshot appears under its final name at once."""
    os.makedirs(config.snapshot_path, exist_ok=True)
    path = os.path.join(config.snapshot_path, name)
    with open(os.path.join(config.snapshot_path, "." + name), "w") as file:
        json.dump({"tm": {"@id": model, "poi": list(incidents)}}, file, indent=1)
    os.rename(file.name, path)
    time.sleep(0.02)


@pytest.fixture
def config(tmp_path):
    return FeedConfig.under(str(tmp_path), trigger_seconds=0, poll_seconds=0)


def table(spark, path, schema, config):
    return sources.read_table(spark, path, schema, config)


def test_snapshots_flow_through_all_stages(spark, config):
    config = config.with_(max_files_per_trigger=1)
    land(config, "a.json", incident("1", "00:01"), incident("", "00:01"), incident("2", "00:02"))
    land(config, "b.json", incident("1", "00:05", dl=999), incident("3", "00:12", dl=30))
    run_stages(spark, config, drain=True)
    land(config, "c.json", incident("4", "01:00"))
    run_stages(spark, config, drain=True)

    bronze = table(spark, config.bronze_table, BRONZE, config)
    assert sorted(r.id for r in bronze.collect()) == ["1", "2", "3", "4"]
    silver = table(spark, config.silver_table, SILVER, config)
    assert silver.where("event_date = '2024-01-01'").count() == 4
    gold = table(spark, config.gold_table, GOLD, config).orderBy("window_start")
    found = [(str(r.window_start), r.type_code, r.road, r.event_count, r.avg_delay_seconds)
             for r in gold.collect()]
    assert found == [
        ("2024-01-01 00:00:00", "8", "r1", 2, 60.0),
        ("2024-01-01 00:10:00", "8", "r1", 1, 30.0),
    ]


def test_silver_is_laid_out_by_day(spark, config):
    next_day = incident("2", "00:02", st="2024-01-02T00:00:00Z")
    land(config, "a.json", incident("1", "00:01"), next_day)
    run_stages(spark, config, ["publish", "bronze", "silver"], drain=True)
    folders = {name for name in os.listdir(config.silver_table) if name.startswith("event_date")}
    assert folders == {"event_date=2024-01-01", "event_date=2024-01-02"}


def test_one_snapshot_per_batch_lets_the_first_copy_win(spark, config):
    config = config.with_(max_files_per_trigger=1)
    for number in range(4):
        land(config, f"{number}.json", incident("1", "00:01", d=f"copy {number}"))
    run_stages(spark, config, ["publish"], drain=True)
    messages = sources.read_messages(spark, config)
    rows = bronze_rows(messages).collect()
    assert [r.description for r in rows] == ["copy 0"]


def test_first_position_wins_within_a_snapshot(spark, config):
    copies = [incident("1", "00:01", d=f"copy {n}") for n in range(20)]
    land(config, "a.json", *copies)
    run_stages(spark, config, ["publish"], drain=True)
    rows = bronze_rows(sources.read_messages(spark, config)).collect()
    assert [r.description for r in rows] == ["copy 0"]


def test_incidents_are_counted_while_polling(spark, config):
    land(config, "a.json", incident("1", "00:01"), incident("", "00:02"))
    land(config, "b.json", incident("1", "00:01"))
    with open(os.path.join(config.snapshot_path, "c.json"), "w") as file:
        file.write("not json")
    for path in (config.wire_path, config.first_copies_path):
        os.makedirs(path)
    query = start_publish(spark, config, available_now=True)
    query.awaitTermination()
    observed = query.recentProgress[0]["observedMetrics"]
    assert observed["polled"]["snapshots"] == 3 and observed["polled"]["unreadable"] == 1
    assert observed["exploded"]["incidents"] == 3


def test_bounding_box_is_applied_when_asked(spark, config):
    config = config.with_(apply_bbox=True)
    inside, outside = {"x": -122.4, "y": 37.75}, {"x": 0, "y": 0}
    land(config, "a.json", incident("1", "00:01", p=inside), incident("2", "00:01", p=outside))
    run_stages(spark, config, ["publish"], drain=True)
    rows = bronze_rows(sources.read_messages(spark, config)).collect()
    assert [r.id for r in rows] == ["1"]


def test_quarantine_keeps_unreadable_messages_out_of_silver(spark, config):
    config = config.with_(quarantine=True)
    os.makedirs(config.wire_path)
    with open(os.path.join(config.wire_path, "m.txt"), "w") as file:
        file.write('{"id":"a","_raw":{"st":"2024-01-01T00:00:00Z"}}\njunk\n{"id":"b"\n')
    run_stages(spark, config, ["bronze", "silver", "quarantine"], drain=True)
    silver = table(spark, config.silver_table, SILVER, config)
    assert [r.incident_id for r in silver.collect()] == ["a"]
    kept = spark.read.parquet(config.quarantine_table)
    assert {r.value for r in kept.collect()} == {"junk", '{"id":"b"'}


def test_stages_run_side_by_side_and_stop(spark, config):
    land(config, "a.json", incident("1", "00:01"), incident("2", "01:00"))
    running = start_stages(spark, config)
    try:
        assert [name for name, _ in running] == ["publish", "bronze", "silver", "gold"]
        for _ in range(120):
            hold(running, 0.5)
            if os.path.isdir(config.gold_table):
                if table(spark, config.gold_table, GOLD, config).count():
                    break
        assert table(spark, config.gold_table, GOLD, config).count() == 1
    finally:
        stop_all(running)
    assert not any(query.isActive for _, query in running)


def test_without_a_hold_the_stages_stop_at_once(spark, config):
    run_stages(spark, config)
    assert spark.streams.active == []


def test_a_stage_that_dies_ends_the_hold_and_stops_the_rest(spark, config, monkeypatch):
    from roadpulse.streaming import runner

    def failing(spark, config, available_now=False):
        source = spark.readStream.format("rate").load()
        broken = source.select(F.raise_error(F.lit("broken stage")).cast("string").alias("value"))
        return (
            broken.writeStream.format("text")
            .option("checkpointLocation", config.gold_checkpoint)
            .start(config.gold_table)
        )

    monkeypatch.setattr(runner._stages, "start_gold", failing)
    with pytest.raises(RuntimeError, match="stage gold ended early"):
        run_stages(spark, config, keep_running_seconds=60)
    assert spark.streams.active == []


def test_a_failed_poll_is_tried_again(spark, config, monkeypatch, caplog):
    from roadpulse.streaming import runner

    land(config, "a.json", incident("1", "00:01"))
    start, tries = runner._stages.start_publish, []

    def failing_once(spark, config, available_now=False):
        tries.append(1)
        if len(tries) > 1:
            return start(spark, config, available_now)
        rows = spark.readStream.text(config.snapshot_path)
        broken = rows.select(F.raise_error(F.lit("bad poll")).cast("string").alias("value"))
        return sinks.message_writer(broken, config.gold_checkpoint, config).start()

    monkeypatch.setattr(runner._stages, "start_publish", failing_once)
    run_stages(spark, config, ["publish"], keep_running_seconds=15)
    assert len(tries) == 2 and "bad poll" in caplog.text
    rows = bronze_rows(sources.read_messages(spark, config)).collect()
    assert [r.id for r in rows] == ["1"]


def test_a_stage_that_cannot_start_stops_those_before_it(spark, config, monkeypatch):
    from roadpulse.streaming import runner

    def refusing(spark, config, available_now=False):
        raise ValueError("no")

    monkeypatch.setattr(runner._stages, "start_silver", refusing)
    with pytest.raises(ValueError, match="no"):
        start_stages(spark, config)
    assert spark.streams.active == []


def test_unknown_stage(spark, config):
    with pytest.raises(ValueError, match="platinum"):
        start_stages(spark, config, ["platinum"])


def test_tail_prints_some_rows_and_counts_the_rest(spark, config, capfd):
    os.makedirs(config.wire_path)
    with open(os.path.join(config.wire_path, "m.txt"), "w") as file:
        file.write("".join(f'{{"id":"id-{n:02}"}}\n' for n in range(50)))
    query = start_tail(spark, config.with_(tail_rows=7))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    shown = capfd.readouterr().out
    assert "50 rows, 43 of them not shown" in shown
    assert sum(f"id-{n:02}" in shown for n in range(50)) == 7


def test_tailed_rows_are_parsed(spark, config):
    os.makedirs(config.wire_path)
    with open(os.path.join(config.wire_path, "m.txt"), "w") as file:
        file.write('{"id":"a","typeCode":1}\n')
    rows = bronze_rows(sources.stream_messages(spark, config))
    query = rows.writeStream.format("memory").queryName("tailed").start()
    try:
        query.processAllAvailable()
        assert [(r.id, r.typeCode) for r in spark.table("tailed").collect()] == [("a", "1")]
    finally:
        query.stop()


def test_written_days_are_few_files_each(spark, config):
    rows = spark.range(0, 4000, numPartitions=16).select(
        F.expr("date_add(date '2024-01-01', cast(id % 3 as int))").alias("event_date"),
        F.col("id").cast("string").alias("incident_id"),
    )
    sinks.write_table(rows, config.silver_table, config, partition_by=["event_date"])
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        names = os.listdir(f"{config.silver_table}/event_date={day}")
        assert len([n for n in names if n.endswith(".parquet")]) <= 2
    assert spark.read.parquet(config.silver_table).count() == 4000


@pytest.mark.parametrize("attempt", range(3))
def test_first_copy_wins_among_many_files_of_one_batch(spark, config, attempt):
    """Files in the order of their times, all in one micro-batch: the first one's copies pass."""
    for number in range(40):
        copies = [incident(str(n), "00:01", d=f"file {number}", dl=number) for n in range(25)]
        land(config, f"{(number * 17) % 40:02}.json", *copies)
    run_stages(spark, config, ["publish"], drain=True)
    land(config, "later.json", incident("3", "00:01", d="later"), incident("new", "00:01", d="later"))
    run_stages(spark, config, ["publish"], drain=True)
    rows = bronze_rows(sources.read_messages(spark, config)).collect()
    assert sorted((r.id, r.description) for r in rows) == sorted(
        [(str(n), "file 0") for n in range(25)] + [("new", "later")]
    )


def test_poll_key_orders_lines_of_any_file(spark, config):
    config = config.with_(whole_files=False, poll_key="polled")
    os.makedirs(config.snapshot_path)
    for number, polls in enumerate([(9, 5), (3, 10), (4, 100)]):
        with open(os.path.join(config.snapshot_path, f"{number}.txt"), "w") as file:
            for poll in polls:
                copy = incident("1", "00:01", d=f"poll {poll}")
                file.write(json.dumps({"polled": poll, "tm": {"@id": "m", "poi": [copy]}}) + "\n")
    run_stages(spark, config, ["publish"], drain=True)
    rows = bronze_rows(sources.read_messages(spark, config)).collect()
    assert [r.description for r in rows] == ["poll 3"]


@pytest.mark.parametrize("complete", [False, True])
def test_a_batch_that_failed_between_the_steps_is_sent_once(spark, config, monkeypatch, complete):
    """The first step has written its rows, or part of them, and the second has not run."""
    from roadpulse.streaming import stages

    land(config, "a.json", incident("1", "00:01"), incident("2", "00:02"))
    send = sinks.message_writer
    monkeypatch.setattr(stages.sinks, "message_writer", lambda *a, **k: 1 / 0)
    with pytest.raises(Exception, match="division by zero"):
        run_stages(spark, config, ["publish"], drain=True)
    monkeypatch.setattr(stages.sinks, "message_writer", send)
    folder = os.path.join(config.first_copies_path, "batch-000000000000")
    if not complete:
        os.rename(f"{folder}/_SUCCESS", f"{config.snapshot_path}/../was_success")
    for _ in range(2):
        run_stages(spark, config, ["publish"], drain=True)
    rows = bronze_rows(sources.read_messages(spark, config)).collect()
    assert sorted(r.id for r in rows) == ["1", "2"]


def test_folders_of_first_copies_go_once_taken(spark, config):
    config = config.with_(max_files_per_trigger=1)
    for number in range(12):
        land(config, f"{number}.json", incident(str(number), "00:01"), incident("again", "00:02"))
    run_stages(spark, config, ["publish"], drain=True)
    assert len(os.listdir(config.first_copies_path)) <= 2
    land(config, "more.json", incident("more", "00:01"), incident("3", "00:02"))
    run_stages(spark, config, ["publish"], drain=True)
    rows = bronze_rows(sources.read_messages(spark, config)).collect()
    assert sorted(r.id for r in rows) == sorted([*map(str, range(12)), "again", "more"])
    assert len([x for x in os.listdir(config.first_copies_path) if x.startswith("batch-")]) <= 2


def test_publish_reduces_below_the_exchange(spark, config, plan):
    from roadpulse.operators import first_per_key
    from roadpulse.streaming import incident_rows

    land(config, "a.json", incident("1", "00:01"))
    rows = incident_rows(sources.read_snapshots(spark, config), config)
    text = plan(first_per_key(rows, ["key"], [F.col(x) for x in ("arrival", "position_in_snapshot")]))
    above, below = text.split("Exchange hashpartitioning(key")[:2]
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below and "Partial" in below


def test_publish_keeps_its_keys_in_rocksdb(spark, config, monkeypatch):
    from roadpulse.streaming import stages

    seen = []
    send = sinks.message_writer

    def watched(rows, *args, **kwargs):
        seen.append(rows.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass"))
        return send(rows, *args, **kwargs)

    land(config, "a.json", incident("1", "00:01"))
    monkeypatch.setattr(stages.sinks, "message_writer", watched)
    run_stages(spark, config, ["publish"], drain=True)
    assert len(seen) == 1 and seen[0].endswith("RocksDBStateStoreProvider")


def age(path, days):
    at = time.time() - days * 86_400
    os.utime(path, (at, at))


def test_old_files_are_read(spark, config):
    land(config, "a.json", incident("1", "00:01"))
    run_stages(spark, config, ["publish", "bronze"], drain=True)
    land(config, "b.json", incident("2", "00:01"))
    age(os.path.join(config.snapshot_path, "b.json"), 30)
    run_stages(spark, config, ["publish"], drain=True)
    name = next(n for n in sorted(os.listdir(config.wire_path)) if n.startswith("part"))
    rows = bronze_rows(sources.read_messages(spark, config)).collect()
    assert name and sorted(r.id for r in rows) == ["1", "2"]


def test_read_snapshots_can_be_archived(spark, config, tmp_path):
    config = config.with_(archive_path=str(tmp_path / "archive"))
    for name in ("a", "b"):
        land(config, f"{name}.json", incident(name, "00:01"))
        run_stages(spark, config, ["publish"], drain=True)
    left = [n for n in os.listdir(config.snapshot_path) if n.endswith(".json") and n[0] != "."]
    found = [n for _, _, names in os.walk(tmp_path / "archive") for n in names if n.endswith(".json")]
    assert sorted(left + found) == ["a.json", "b.json"] and "a.json" in found


def test_batch_and_stream_refuse_each_others_folders(spark, config):
    os.makedirs(config.wire_path)
    with open(os.path.join(config.wire_path, "m.txt"), "w") as file:
        file.write('{"id":"a","_raw":{"st":"2024-01-01T00:00:00Z"}}\n')
    run_stages(spark, config, ["bronze"], drain=True)
    rows = bronze_rows(sources.read_messages(spark, config))
    with pytest.raises(ValueError, match="a stream writes"):
        sinks.write_table(rows, config.bronze_table, config)
    sinks.write_table(rows, config.gold_table, config)
    with pytest.raises(ValueError, match="files of a batch"):
        run_stages(spark, config, ["gold"], drain=True)
    # What is put beside the table is part of it, for readers and for the next stage.
    sinks.backfill_table(rows.withColumn("id", F.lit("b")), config.bronze_table, config)
    assert table(spark, config.bronze_table, BRONZE, config).count() == 2
    run_stages(spark, config, ["silver"], drain=True)
    silver = table(spark, config.silver_table, SILVER, config)
    assert sorted(r.incident_id for r in silver.collect()) == ["a", "b"]


def test_a_batch_of_messages_does_not_go_into_a_published_folder(spark, config):
    land(config, "a.json", incident("1", "00:01"))
    run_stages(spark, config, ["publish"], drain=True)
    with pytest.raises(ValueError, match="a stream writes"):
        sinks.write_messages(spark.createDataFrame([("{}",)], "value string"), config)


@pytest.mark.parametrize("buckets", [1, 3])
def test_a_micro_batch_adds_few_files_per_day(spark, config, buckets):
    config = config.with_(silver_buckets=buckets)
    rows = spark.range(0, 2000, numPartitions=8).select(
        F.col("id").cast("string").alias("id"),
        F.expr("timestamp '2024-01-01' + make_dt_interval(cast(id % 10 as int))").alias("event_ts"),
    )
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in BRONZE if f.name not in rows.columns]
    sinks.write_table(rows.select("*", *missing).select(BRONZE.names), config.bronze_table, config)
    run_stages(spark, config, ["silver"], drain=True)
    files = [n for _, _, names in os.walk(config.silver_table) for n in names if n.endswith(".parquet")]
    assert 10 <= len(files) <= 10 * buckets
    assert table(spark, config.silver_table, SILVER, config).count() == 2000


def test_a_full_day_is_written_by_several_tasks(spark, config):
    """Without a setting, by the size of the batch."""
    rows = spark.range(0, 40_000, numPartitions=8).select(
        F.col("id").cast("string").alias("id"),
        F.sha2(F.col("id").cast("string"), 512).alias("description"),
        F.expr("timestamp '2024-01-01' + make_dt_interval(if(id % 100 = 0, 1, 0))").alias("event_ts"),
    )
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in BRONZE if f.name not in rows.columns]
    sinks.write_table(rows.select("*", *missing).select(BRONZE.names), config.bronze_table, config)
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k"}):
        run_stages(spark, config, ["silver"], drain=True)
    days = {
        os.path.basename(place): sum(n.endswith(".parquet") for n in names)
        for place, _, names in os.walk(config.silver_table) if "event_date=" in place
    }
    assert 2 <= days["event_date=2024-01-01"] <= 20 and days["event_date=2024-01-02"] <= 3
    assert table(spark, config.silver_table, SILVER, config).count() == 40_000


# ---------------------------------------------------------------- settings


def test_environment_overrides_defaults():
    config = FeedConfig.from_env(
        {"KAFKA_TOPIC": "t", "BBOX": "1,2,3,4", "POLL_SECONDS": "5", "SILVER_PATH": "/s"},
        transport="files",
    )
    assert (config.kafka_topic, config.poll_seconds) == ("t", 5)
    assert config.bbox == (1.0, 2.0, 3.0, 4.0)
    assert config.silver_table == "/s/incidents" and config.transport == "files"
    assert FeedConfig.from_env({}) == FeedConfig()


def test_settings_are_checked():
    with pytest.raises(ValueError):
        FeedConfig(transport="pigeon")
    with pytest.raises(ValueError):
        FeedConfig(table_format="csv")
    with pytest.raises(ValueError):
        parse_bbox("1,2,3")


def test_every_location_moves_under_one_root():
    config = FeedConfig.under("/shared/run")
    paths = [v for k, v in vars(config).items() if k.endswith(("_path", "_checkpoint"))]
    paths = [path for path in paths if path is not None]
    assert len(paths) == len(set(paths)) == 13
    assert all(path.startswith("/shared/run/") for path in paths)


def test_kafka_options():
    config = FeedConfig(kafka_bootstrap="b:1", kafka_topic="t", max_offsets_per_trigger=9, min_topic_splits=64)
    assert sources.kafka_options(config) == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "9",
        "minPartitions": "64",
    }
    from roadpulse.sinks.writers import kafka_sink_options

    assert kafka_sink_options(config) == {"kafka.bootstrap.servers": "b:1", "topic": "t"}


def test_missing_connectors_say_so(spark):
    """Kafka and Delta need their jars; the option assembly above is all that runs here."""
    with pytest.raises((PySparkException, Py4JJavaError), match="kafka"):
        sources.stream_messages(spark, FeedConfig(transport="kafka"))
    with pytest.raises((PySparkException, Py4JJavaError), match="delta"):
        delta = FeedConfig(table_format="delta")
        sources.stream_table(spark, "/nowhere", BRONZE, delta)
    assert set(DELTA_SETTINGS) == {"spark.sql.extensions", "spark.sql.catalog.spark_catalog"}


def test_work_folders_are_fresh_and_below_the_shared_root(spark):
    first, second = new_work_dir(spark, "x"), new_work_dir(spark, "x")
    assert first != second
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert first.startswith(configured.rstrip("/")) and shared_root(spark)


def test_command_line_drains_the_chosen_stages(spark, config, tmp_path):
    from roadpulse.__main__ import main

    land(config, "a.json", incident("1", "00:01"), incident("2", "01:00"))
    main(["--root", str(tmp_path), "--drain", "--skip", "gold"])
    assert table(spark, config.silver_table, SILVER, config).count() == 2
    assert not os.path.exists(config.gold_table)


def test_command_line_settings(monkeypatch):
    from roadpulse.__main__ import arguments, configured

    env = {"KAFKA_TOPIC": "t", "POLL_SECONDS": "9", "BBOX": "1,2,3,4"}
    found = configured(arguments(["--root", "/r"]), env)
    assert (found.transport, found.kafka_topic, found.poll_seconds) == ("files", "t", 9)
    assert found.wire_path == "/r/data/wire" and found.bbox == (1.0, 2.0, 3.0, 4.0)
    assert configured(arguments(["--root", "/r", "--transport", "kafka"]), env).transport == "kafka"
    assert configured(arguments([]), env).transport == "kafka"
    with pytest.raises(SystemExit, match="SILVER_PATH"):
        configured(arguments(["--root", "/r"]), {**env, "SILVER_PATH": "/s"})
    places = {
        "SNAPSHOT_PATH": "/a",
        "WIRE_PATH": "/b",
        "PUBLISH_CHECKPOINT": "/c",
        "QUARANTINE_CHECKPOINT": "/d",
    }
    found = configured(arguments(["--transport", "files"]), places)
    assert [found.snapshot_path, found.wire_path] == ["/a", "/b"]
    assert [found.publish_checkpoint, found.quarantine_checkpoint] == ["/c", "/d"]


def test_topic_settings():
    config = FeedConfig(starting_offsets="earliest", fail_on_data_loss=True)
    options = sources.kafka_options(config)
    assert (options["startingOffsets"], options["failOnDataLoss"]) == ("earliest", "true")


def test_folders_of_one_machine_are_refused_on_a_cluster(spark, tmp_path, monkeypatch):
    from roadpulse import session

    config = FeedConfig.under(str(tmp_path))
    session.require_shared(spark, config.locations)
    monkeypatch.setattr(session, "is_local", lambda spark: False)
    with pytest.raises(RuntimeError, match="a folder of one machine"):
        session.require_shared(spark, config.locations)
    monkeypatch.setattr(session, "CHECKPOINT_DIR", "spark.test.checkpoint.dir")
    spark.conf.set("spark.test.checkpoint.dir", f"file://{tmp_path}")
    session.require_shared(spark, config.locations)

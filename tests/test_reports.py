"""Reports of micro-batches as a table, and the state of publish as one."""

from __future__ import annotations

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from roadpulse import FeedConfig, sources
from roadpulse.session import settings
from roadpulse.streaming import (
    bronze_rows,
    read_progress,
    reseed_publish,
    run_stages,
    seen_keys,
    start_stages,
    state_partitions,
    stop_all,
)
from roadpulse.streaming.progress import progress_log


@pytest.fixture
def config(tmp_path):
    return FeedConfig.under(str(tmp_path / "a"), trigger_seconds=0, poll_seconds=0, whole_files=False, poll_key="polled")


def land(config, polled, *ids, text=None):
    os.makedirs(config.snapshot_path, exist_ok=True)
    poi = [{"id": i, "ty": 1, "st": f"2024-01-01T{polled:02d}:00:00Z"} for i in ids]
    with open(os.path.join(config.snapshot_path, f"{polled}.json"), "w") as file:
        file.write(text or json.dumps({"polled": polled, "tm": {"@id": "m", "poi": poi}}))


def sent(spark, config):
    return sorted(x.id for x in bronze_rows(sources.read_messages(spark, config)).collect())


def test_every_micro_batch_leaves_a_row(spark, config):
    config = config.with_(max_files_per_trigger=1)
    land(config, 1, "a", "b")
    land(config, 2, "a", "c")
    land(config, 3, text="not json")
    run_stages(spark, config, drain=True)
    land(config, 9, "d")
    run_stages(spark, config, drain=True)
    rows = read_progress(spark, config)
    polls = rows.where("stage = 'publish'").orderBy("batch_id").collect()
    assert [x.batch_id for x in polls] == [0, 1, 2, 3]
    assert sum(x.counts["polled.snapshots"] for x in polls) == 4
    assert sum(x.counts["polled.unreadable"] for x in polls) == 1
    assert sum(x.counts["exploded.incidents"] for x in polls) == 5
    assert {x.stage for x in rows.select("stage").distinct().collect()} == {"publish", "bronze", "silver", "gold"}
    marks = rows.where("stage = 'gold'").agg(F.max("watermark")).first()[0]
    assert marks == datetime.datetime(2024, 1, 1, 8, 30)
    assert rows.where("stage = 'silver'").agg(F.sum("input_rows")).first()[0] == 4


def test_rows_behind_the_watermark_are_reported(spark, config):
    config = config.with_(max_files_per_trigger=1)
    for polled, name in ((20, "a"), (21, "b"), (2, "late")):
        land(config, polled, name)
        run_stages(spark, config, drain=True)
    gold = read_progress(spark, config).where("stage = 'gold'")
    assert gold.agg(F.sum("late_rows")).first()[0] == 1
    assert run_stages(spark, config, drain=True) is None
    assert read_progress(spark, config).groupBy("query_id", "batch_id").count().where("count > 1").isEmpty()


def test_running_stages_report_too_and_it_can_be_turned_off(spark, config):
    land(config, 1, "a")
    with progress_log(spark, config) as log:
        running = start_stages(spark, config, ["publish", "bronze"])
        for _, query in running:
            query.processAllAvailable()
        stop_all(running)
        for _, query in running:
            log.wait_for(query)
    assert read_progress(spark, config).where("stage = 'publish' and input_rows > 0").count() == 1
    quiet = config.with_(log_progress=False, metrics_path=config.metrics_path + "_none")
    run_stages(spark, quiet, drain=True)
    assert read_progress(spark, quiet).count() == 0


def test_keys_move_to_a_checkpoint_of_another_width(spark, config, tmp_path):
    land(config, 1, "a", "b")
    land(config, 2, "c")
    run_stages(spark, config, ["publish"], drain=True)
    assert sent(spark, config) == ["a", "b", "c"]
    keys = {bytes(x.key) for x in seen_keys(spark, config).collect()}
    assert len(keys) == 3
    assert state_partitions(spark, config).agg(F.sum("keys")).first()[0] == 3

    new = FeedConfig.under(str(tmp_path / "b"), whole_files=False, poll_key="polled")
    with settings(spark, {"spark.sql.shuffle.partitions": "7"}):
        reseed_publish(spark, config, new)
    land(new, 3, "a", "d")
    run_stages(spark, new, ["publish"], drain=True)
    land(new, 4, "b", "d", "e")
    run_stages(spark, new, ["publish"], drain=True)
    assert sent(spark, new) == ["d", "e"]
    assert {bytes(x.key) for x in seen_keys(spark, new).collect()} > keys
    with open(f"{new.publish_checkpoint}/sent/offsets/0") as file:
        assert '"spark.sql.shuffle.partitions":"7"' in file.read()
    assert not [x for x in os.listdir(new.first_copies_path) if x.startswith("batch--")]
    with pytest.raises(ValueError, match="seen incidents already"):
        reseed_publish(spark, config, new)
    with pytest.raises(ValueError, match="forgotten"):
        reseed_publish(spark, config, new.with_(dedup_bound="1 day"))

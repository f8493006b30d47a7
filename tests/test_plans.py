"""What Catalyst makes of the operators."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from roadpulse import catalog
from roadpulse.operators import (
    aggregate_windows,
    first_per_key,
    normalize,
    parse_events,
    watermarked,
)
from roadpulse.plans.derived import read_events, silver_like, wire_messages
from roadpulse.schemas import BRONZE, SILVER

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def silver_table(spark, tmp_path):
    path = str(tmp_path / "silver")
    silver_like(read_events(spark, SF_DIR)).write.partitionBy("event_date").parquet(path)
    return spark.read.schema(SILVER).parquet(path)


def test_gold_reads_four_columns_and_combines_before_its_one_shuffle(plan, silver_table):
    text = plan(aggregate_windows(silver_table))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {part.split(":")[0] for part in read.split(",")} == {
        "typeCode",
        "road",
        "delay_seconds",
        "event_ts",
    }
    assert text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("partial_count")
    assert "IsNotNull(event_ts)" in text


def test_streamed_gold_reads_four_columns_and_combines_before_its_shuffle(
    spark, silver_table, tmp_path
):
    folder = silver_table.inputFiles()[0].split("/event_date=")[0]
    clean = watermarked(spark.readStream.schema(SILVER).parquet(folder))
    query = (
        aggregate_windows(clean)
        .writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert progress[0]["numInputRows"] == 1000
    # The last batch has no data, but the same operators above an empty scan.
    text = query._jsq.explainInternal(False)
    assert text.index("StateStoreSave") < text.index("Exchange") < text.index("partial_count")
    scan = re.search(r"LocalTableScan <empty>, \[([^\]]*)\]", text).group(1)
    assert {name.split("#")[0] for name in scan.split(", ")} <= {
        "typeCode",
        "road",
        "delay_seconds",
        "event_ts",
    }


def test_a_day_prunes_folders(plan, silver_table):
    day = silver_table.where(F.col("event_date") == "2024-01-02")
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan(aggregate_windows(day)))


def test_first_per_key_limits_each_key_before_the_shuffle(spark, plan):
    rows = first_per_key(read_events(spark, SF_DIR), ["event_type"], ["event_id"])
    text = plan(rows)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_parse_and_normalize_do_not_shuffle_and_read_json_once(spark, plan):
    text = plan(normalize(parse_events(wire_messages(read_events(spark, SF_DIR)))))
    assert "Exchange" not in text
    assert text.count("from_json") == 1


def test_silver_reads_only_what_it_keeps(spark, plan, tmp_path):
    path = str(tmp_path / "bronze")
    parse_events(wire_messages(read_events(spark, SF_DIR))).write.parquet(path)
    text = plan(normalize(spark.read.schema(BRONZE).parquet(path)))
    assert "_raw" not in re.search(r"ReadSchema: (.*)", text).group(1)


BATCH = [name for name in catalog.queries() if not name.endswith(("_stream", "_chain", "_settled"))
         and name != "dedup_stream_hot_keys"]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join(spark, plan, name):
    text = plan(catalog.queries()[name](spark, SF_DIR))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text
    if name != "gold_10m_closed":  # its bound is one row
        assert "SinglePartition" not in text

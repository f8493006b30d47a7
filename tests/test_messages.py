from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from roadpulse.catalog.streams import _land_snapshots
from roadpulse.config import FeedConfig
from roadpulse.operators import (
    explode_texts,
    flatten_incidents,
    messages_of_texts,
    read_texts,
    to_messages,
    with_id,
)
from roadpulse.plans import publish_batch
from roadpulse.streaming import message_rows

EMPTY = ["null", '""', "0", "0.0", "false", "{}", "[]"]
SAYING = ['"x"', "7", "-1.5", "true", '{"k":[1]}', "[0]"]


def document(*incidents: str, model: str = '"m"') -> str:
    return '{"tm":{"@id":%s,"poi":[%s]}}' % (model, ",".join(incidents))


def published(spark, *payloads: str) -> list[str]:
    documents = spark.createDataFrame(list(enumerate(payloads)), "n int, payload string")
    return sorted(row.value for row in publish_batch(documents, ["n"]).collect())


@pytest.mark.parametrize("road", EMPTY + SAYING)
@pytest.mark.parametrize("street", ['""', "3"])
def test_message_has_the_types_and_label_of_its_text(spark, road, street):
    text = '{"id":"a","dl":5,"p":{"x":1,"y":2.5},"r":%s,"f":%s,"t":"T","more":[null]}' % (road, street)
    incident = json.loads(text)
    label = next((incident[key] for key in ("r", "f") if incident[key]), "T")
    (message,) = published(spark, document(text))
    assert json.loads(message) == {
        "trafficModelId": "m", "id": "a", "typeCode": None, "iconCode": None, "description": None,
        "comment": None, "from": incident["f"], "to": "T", "road": incident["r"], "delaySeconds": 5,
        "position": {"x": 1, "y": 2.5}, "area_hint": label, "_raw": incident,
    }


def test_text_that_holds_a_key_twice_gives_texts_and_the_last_value(spark):
    (message,) = published(spark, document('{"id":"a","dl":5,"r":"old","r":"new","q":1}'))
    found = json.loads(message)
    assert (found["id"], found["delaySeconds"], found["road"], found["area_hint"]) == ("a", 5, "new", "new")
    assert found["_raw"] == {"id": "a", "dl": "5", "r": "new", "q": "1"}


def test_messages_are_those_of_the_flattened_events(spark):
    texts = ['{"id":"a","ty":1,"r":"","t":[2]}', '{"id":"b","r":1,"r":2}', '{"id":3,"f":0,"p":"q"}']
    rows = spark.createDataFrame([("m", text) for text in texts], "trafficModelId string, text string")
    by_events = to_messages(flatten_incidents(read_texts(rows), "text"), "text")
    assert messages_of_texts(rows).collect() == by_events.collect()


@pytest.mark.parametrize("payload", [None, "", "junk", "{}", '{"tm":null}', '{"tm":{"poi":null}}', document()])
def test_document_without_incidents_gives_no_text(spark, payload):
    rows = spark.createDataFrame([(1, payload)], "n int, payload string")
    assert explode_texts(rows).collect() == []


def test_elements_keep_their_place_and_those_without_id_go(spark):
    rows = spark.createDataFrame(
        [(1, document('{"id":"a"}', "null", "5", '{"id":""}', '{"id":null}', '{"ty":1}', '{"id":7}', model="null"))],
        "n int, payload string",
    )
    exploded = explode_texts(rows)
    assert sorted(row.position_in_snapshot for row in exploded.collect()) == list(range(7))
    found = with_id(exploded).orderBy("position_in_snapshot").collect()
    assert [(r.n, r.trafficModelId, r.position_in_snapshot, r.incident.id) for r in found] == [
        (1, "", 0, "a"),
        (1, "", 6, "7"),
    ]


def test_each_text_is_parsed_once(spark, plan, tmp_path):
    """The values, the kinds and the label of a message come from one parse of its text."""
    rows = spark.createDataFrame([("m", "{}")], "trafficModelId string, text string")
    shown = plan(messages_of_texts(rows))
    assert shown.count("parseJson") == 1
    for key in ("r", "f", "t", "dl"):
        assert shown.count(f", $.{key}, VariantType") == 1
    config = FeedConfig.under(str(tmp_path), dedup_bound=None)
    keyed = rows.withColumn("key", F.col("text").cast("binary"))
    assert plan(message_rows(keyed, config)).count("parseJson") == 1


def test_id_of_an_incident_is_read_once(spark, plan):
    """Dropping incidents without id and making the key read no text again."""
    rows = spark.createDataFrame([(1, document('{"id":"a"}'))], "n int, payload string")
    only_id = r"from_json\(StructField\(id,StringType,true\), (?!StructField)"
    assert len(re.findall(only_id, plan(publish_batch(rows, ["n"])))) == 1


def test_landed_documents_lie_in_several_files_on_all_cores(spark, tmp_path):
    events = spark.range(400).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds("id").alias("event_ts"),
        (F.col("id") % 9).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.col("id").cast("double").alias("value"),
        F.lit("{}").alias("props"),
    )
    config = FeedConfig.under(str(tmp_path), whole_files=False)
    _land_snapshots(events.coalesce(1), config)
    landed = spark.read.text(config.snapshot_path)
    assert landed.count() == 400
    width = max(8, spark.sparkContext.defaultParallelism)
    assert landed.select(F.input_file_name()).distinct().count() == width

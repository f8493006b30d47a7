from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import first_label, incident_key
from roadpulse.operators import (
    explode_snapshots,
    flatten_incidents,
    incidents_per_snapshot,
    parse_events,
    stamp_events,
    to_messages,
    with_id,
    within_bbox,
)
from roadpulse.plans import new_incidents
from roadpulse.schemas import BRONZE, WIRE


def documents(spark, *payloads):
    return spark.createDataFrame(list(enumerate(payloads)), "n int, payload string")


def ids(spark, *payloads):
    rows = with_id(explode_snapshots(documents(spark, *payloads)))
    ordered = rows.orderBy("n", "position_in_snapshot")
    return [(row.trafficModelId, row.incident.id) for row in ordered.collect()]


FULL = {
    "id": "a",
    "ty": 8,
    "ic": 2,
    "d": "jam",
    "c": "slow",
    "f": "F",
    "t": "T",
    "r": "",
    "dl": 3,
    "p": {"x": -122.4, "y": 37.75},
    "st": "2024-01-01T00:00:00Z",
    "other": {"k": [1, 2]},
}


def snapshot(*incidents, model="1"):
    return json.dumps({"tm": {"@id": model, "poi": list(incidents)}})


def test_only_incidents_with_an_id_pass(spark):
    assert ids(spark, snapshot({"id": "a"}, {"id": ""}, {"ty": 1}, {"id": None})) == [("1", "a")]


@pytest.mark.parametrize(
    "payload",
    ['{"tm":{"poi":null}}', "{}", '{"tm":null}', '{"tm":{"@id":"1"}}', "junk", "", None, "[]", "5"],
)
def test_document_without_incidents_gives_nothing(spark, payload):
    assert ids(spark, payload) == []


def test_missing_model_id_is_empty_text(spark):
    assert ids(spark, '{"tm":{"poi":[{"id":"a"}]}}') == [("", "a")]


def test_document_over_several_lines(spark):
    assert ids(spark, '{\n "tm": {"@id": "1",\n "poi": [{"id": "a"}]}\n}') == [("1", "a")]


@pytest.mark.parametrize("bad", ['"text"', "5", "null", "[1]", "true"])
def test_element_that_is_no_object_costs_only_itself(spark, bad):
    payload = '{"tm":{"@id":"1","poi":[{"id":"a"},%s,{"id":"c","dl":4,"q":1}]}}' % bad
    rows = with_id(explode_snapshots(documents(spark, payload)))
    found = [(r.incident.dl, r["_raw"]) for r in rows.collect()]
    assert found == [(None, {"id": "a"}), (4, {"id": "c", "dl": "4", "q": "1"})]


@pytest.mark.parametrize("bad", ['"12"', "12.7", "[1]", "3000000000", "{}"])
def test_delay_of_another_type_costs_only_itself(spark, bad):
    payload = '{"tm":{"poi":[{"id":"a","dl":%s,"r":"R"},{"id":"b","dl":2}]}}' % bad
    rows = flatten_incidents(with_id(explode_snapshots(documents(spark, payload))))
    assert [(r.id, r.delaySeconds, r.road) for r in rows.collect()] == [
        ("a", None, "R"),
        ("b", 2, None),
    ]


def test_flatten_renames_and_keeps_the_whole_record(spark):
    row = flatten_incidents(explode_snapshots(documents(spark, snapshot(FULL)))).first()
    assert row.asDict() == {
        "trafficModelId": "1",
        "id": "a",
        "typeCode": "8",
        "iconCode": "2",
        "description": "jam",
        "comment": "slow",
        "from": "F",
        "to": "T",
        "road": "",
        "delaySeconds": 3,
        "position": {"x": "-122.4", "y": "37.75"},
        "area_hint": "F",
        "_raw": {
            "id": "a",
            "ty": "8",
            "ic": "2",
            "d": "jam",
            "c": "slow",
            "f": "F",
            "t": "T",
            "r": "",
            "dl": "3",
            "p": '{"x":-122.4,"y":37.75}',
            "st": "2024-01-01T00:00:00Z",
            "other": '{"k":[1,2]}',
        },
    }


def test_a_repeated_key_takes_its_last_value(spark):
    payload = '{"tm":{"poi":[{"id":"a","r":"x","dl":1,"r":"y","id":"b","dl":2,"st":null}]}}'
    row = flatten_incidents(with_id(explode_snapshots(documents(spark, payload)))).first()
    assert (row.id, row.road, row.delaySeconds) == ("b", "y", 2)
    assert row["_raw"] == {"id": "b", "r": "y", "dl": "2", "st": None}
    sizes = flatten_incidents(explode_snapshots(documents(spark, payload))).select(F.size("_raw"))
    assert sizes.first()[0] == 4


def test_flat_event_has_the_wire_columns(spark):
    events = flatten_incidents(explode_snapshots(documents(spark, snapshot(FULL))))
    assert events.columns == WIRE.names
    assert [f.dataType for f in events.schema] == [f.dataType for f in WIRE]


def test_absent_keys_become_null(spark):
    row = flatten_incidents(explode_snapshots(documents(spark, snapshot({"id": "a"})))).first()
    filled = {name for name, value in row.asDict().items() if value is not None}
    assert filled == {"trafficModelId", "id", "_raw"}


@pytest.mark.parametrize(
    "road, start, end, label",
    [
        ("R", "F", "T", "R"),
        ("", "F", "T", "F"),
        (None, "", "T", "T"),
        ("", "", "", ""),
        ("", None, None, None),
        (None, None, "", ""),
        (None, None, None, None),
    ],
)
def test_area_hint(spark, road, start, end, label):
    rows = spark.createDataFrame([(road, start, end)], "a string, b string, c string")
    assert rows.select(first_label("a", "b", "c")).first()[0] == label


@pytest.mark.parametrize("model, incident", [("a", "b"), ("", "a"), (None, "a"), ("é", "ü:x")])
def test_incident_key(spark, model, incident):
    rows = spark.createDataFrame([(model, incident)], "m string, i string")
    expected = hashlib.sha256(f"{model or ''}:{incident}".encode()).hexdigest()
    assert rows.select(incident_key("m", "i")).first()[0] == expected


def test_message_keeps_nulls_and_survives_line_breaks(spark):
    payload = snapshot({"id": "a", "d": 'two\nlines "quoted"'})
    message = to_messages(flatten_incidents(explode_snapshots(documents(spark, payload))))
    text = message.first().value
    assert "\n" not in text
    written = json.loads(text)
    assert list(written) == WIRE.names
    assert written["road"] is None and written["description"] == 'two\nlines "quoted"'


def test_snapshot_to_bronze_round_trip(spark):
    events = flatten_incidents(explode_snapshots(documents(spark, snapshot(FULL))))
    parsed = parse_events(to_messages(events))
    assert [(f.name, f.dataType) for f in parsed.schema] == [(f.name, f.dataType) for f in BRONZE]
    assert parsed.drop("event_ts").collect() == events.collect()
    assert str(parsed.first().event_ts) == "2024-01-01 00:00:00"
    assert stamp_events(events).collect() == parsed.collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_incidents_are_counted_before_any_is_dropped(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    counted = incidents_per_snapshot(
        documents(spark, snapshot({"id": "a"}, {"id": ""}, {}), "{}", '{"tm":{"poi":[]}}', "junk")
    )
    found = [r.incidents for r in counted.orderBy("n").collect()]
    spark.conf.unset("spark.sql.ansi.enabled")
    assert found == [3, 0, 0, 0]


def test_first_copy_wins_within_and_across_snapshots(spark):
    rows = new_incidents(
        documents(
            spark,
            snapshot({"id": "a", "d": "first"}, {"id": "b"}, {"id": "a", "d": "second"}),
            snapshot({"id": "a", "d": "third"}, {"id": "c"}),
            snapshot({"id": "a", "d": "other model"}, model="2"),
        ),
        ["n"],
    )
    found = {(r.trafficModelId, r.id, r.description) for r in flatten_incidents(rows).collect()}
    assert found == {
        ("1", "a", "first"),
        ("1", "b", None),
        ("1", "c", None),
        ("2", "a", "other model"),
    }


def test_bbox_edges_are_inside_and_unreadable_positions_outside(spark):
    rows = spark.createDataFrame(
        [
            (1, {"x": "-122.52", "y": "37.83"}),
            (2, {"x": "-122.53", "y": "37.75"}),
            (3, {"x": "junk", "y": "37.75"}),
            (4, {"x": "-122.4"}),
            (5, None),
            (6, {"x": "-122.4", "y": "37.75"}),
        ],
        "n int, position map<string,string>",
    )
    inside = within_bbox(rows, (-122.52, 37.70, -122.35, 37.83))
    assert sorted(r.n for r in inside.collect()) == [1, 6]


def test_bbox_key_names_are_parameters(spark):
    rows = spark.createDataFrame([({"lon": "1", "lat": "2"},)], "place map<string,string>")
    assert within_bbox(rows, (0, 0, 3, 3), "place", "lon", "lat").count() == 1
    assert within_bbox(rows, (0, 0, 3, 3), "place").count() == 0


def test_other_columns_of_a_document_are_kept(spark):
    rows = documents(spark, snapshot({"id": "a"})).withColumn("origin", F.lit("file"))
    assert explode_snapshots(rows).columns[:2] == ["n", "origin"]


def test_box_on_numeric_columns_reaches_the_scan(spark, tmp_path, plan):
    rows = [(1, -122.4, 37.75), (2, 0.0, 0.0), (3, None, 37.75), (4, -122.52, 37.83)]
    spark.createDataFrame(rows, "id int, lon double, lat double").write.parquet(str(tmp_path / "t"))
    found = within_bbox(
        spark.read.parquet(str(tmp_path / "t")), (-122.52, 37.70, -122.35, 37.83), columns=("lon", "lat")
    )
    assert sorted(r.id for r in found.collect()) == [1, 4]
    assert "GreaterThanOrEqual(lon,-122.52)" in plan(found)

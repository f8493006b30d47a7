"""Random snapshots through Spark and through a plain loop over decoded JSON."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import first_per_key, flatten_incidents, parse_events, to_messages
from roadpulse.plans import new_incidents, publish_batch
from roadpulse.schemas import RAW_TO_WIRE

VALUES = ["", "x", "ü\n\"q\"", "road 1", 7, 8.5, True, None, [1, "a"], {"k": {"n": 1}}]
TEXTS = ["", "A1", "B 2", None]


def random_incident(rng):
    incident = {}
    for key, choices in {
        "id": ["", None, *"abcdefgh", 5],
        "ty": VALUES,
        "ic": VALUES,
        "d": VALUES,
        "c": VALUES,
        "f": TEXTS,
        "t": TEXTS,
        "r": TEXTS,
        "dl": [0, 3, -4, "12", 2.5, None, [1]],
        "p": [{"x": 1.5, "y": "z"}, {}, None, [1], "text"],
        "st": ["2024-01-01T00:00:00Z", "bad", None],
        "other": VALUES,
    }.items():
        if rng.random() < 0.8:
            incident[key] = rng.choice(choices)
    return incident


def random_document(rng):
    form = rng.random()
    if form < 0.05:
        return rng.choice(["", "junk", "{", "[]", "null", '{"tm":[]}'])
    model = {"poi": [random_incident(rng) for _ in range(rng.randrange(6))]}
    if rng.random() < 0.1:
        model["poi"] = None
    if rng.random() < 0.9:
        model["@id"] = rng.choice(["m1", "m2", ""])
    return json.dumps({"tm": None if form > 0.97 else model, "more": 1}, ensure_ascii=False)


def text(value):
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


def texts(value):
    return {k: text(v) for k, v in value.items()} if isinstance(value, dict) else None


def whole(value):
    return value if isinstance(value, int) and not isinstance(value, bool) else None


def loop(documents):
    """The events a plain loop publishes, in order."""
    seen, events = set(), []
    for document in documents:
        try:
            decoded = json.loads(document)
        except ValueError:
            continue
        model = decoded.get("tm") if isinstance(decoded, dict) else None
        if not isinstance(model, dict):
            continue
        model_id = model.get("@id") or ""
        for incident in model.get("poi") or []:
            if not incident.get("id"):
                continue
            key = hashlib.sha256(f"{model_id}:{incident['id']}".encode()).hexdigest()
            if key in seen:
                continue
            seen.add(key)
            event = {wire: text(incident.get(raw)) for raw, wire in RAW_TO_WIRE.items()}
            event["delaySeconds"] = whole(incident.get("dl"))
            event["position"] = texts(incident.get("p"))
            event["area_hint"] = event["road"] or event["from"] or event["to"]
            event["trafficModelId"] = model_id
            event["_raw"] = texts(incident)
            events.append(event)
    return events


@pytest.mark.parametrize("seed", range(3))
def test_published_events_match_a_plain_loop(spark, seed):
    rng = random.Random(seed)
    documents = [random_document(rng) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(documents)), "n int, payload string").repartition(5)
    first = new_incidents(rows, ["n"])
    found = flatten_incidents(first, "n", "position_in_snapshot").orderBy(
        "n", "position_in_snapshot"
    )
    events = [r.asDict() for r in found.drop("n", "position_in_snapshot").collect()]
    assert events == loop(documents)

    parsed = parse_events(publish_batch(rows, ["n"])).select(found.columns[2:])
    sent = [r.asDict() for r in parsed.collect()]
    # The keys of a sent object come in no order that counts.
    show = lambda rows: sorted(json.dumps(row, sort_keys=True) for row in rows)
    assert show(sent) == show(events)


def test_messages_keep_value_and_type(spark):
    """Published messages against ``json.dumps`` of the plain event, types included."""
    rng = random.Random(11)
    documents = [random_document(rng) for _ in range(300)]
    odd = [
        {"id": "r0", "r": 0, "f": "from"},
        {"id": "r1", "r": 0.0, "f": False, "t": "to"},
        {"id": "r2", "r": [], "f": {}, "t": ""},
        {"id": "r3", "r": 5, "f": "from"},
        {"id": "r4", "r": "0", "dl": "12", "p": {"x": 1, "y": {"z": [1.5, None, True]}}},
        {"id": 7, "ty": 8, "ic": True, "dl": 3},
    ]
    documents.append(json.dumps({"tm": {"@id": "odd", "poi": odd}}))
    rows = spark.createDataFrame(list(enumerate(documents)), "n int, payload string")
    messages = publish_batch(rows, ["n"])
    expected = []
    for event, raw in plain_incidents(documents):
        sent = {wire: raw.get(key) for key, wire in RAW_TO_WIRE.items()}
        label = raw.get("r") or raw.get("f") or raw.get("t")
        expected.append({"trafficModelId": event, **sent, "area_hint": label, "_raw": raw})
    found = [json.loads(r.value) for r in messages.collect()]
    assert shown(found) == shown(expected)
    quoted = parse_events(messages).where("id = 'r4'").first()
    assert quoted.delaySeconds is None and quoted.position == {"x": "1", "y": '{"z":[1.5,null,true]}'}


def shown(events):
    """Events as text, in order; JSON has one kind of number, so 2.0 is 2."""

    def plain(value):
        if isinstance(value, dict):
            return {key: plain(item) for key, item in value.items()}
        if isinstance(value, list):
            return [plain(item) for item in value]
        return int(value) if isinstance(value, float) and value.is_integer() else value

    return sorted(json.dumps(plain(event), sort_keys=True) for event in events)


def plain_incidents(documents):
    """(model, raw incident) of each first sighting."""
    seen = set()
    for document in documents:
        try:
            model = json.loads(document)["tm"]
            incidents = model.get("poi") or []
        except (ValueError, KeyError, TypeError, AttributeError):
            continue
        for raw in incidents:
            key = (model.get("@id") or "", str(raw.get("id")))
            if raw.get("id") and key not in seen:
                seen.add(key)
                yield key[0], raw


def test_a_key_held_twice_is_still_sent(spark):
    document = '{"tm":{"@id":"m","poi":[{"id":"a","ty":1,"ty":2,"r":"x"}]}}'
    rows = spark.createDataFrame([(0, document)], "n int, payload string")
    event = parse_events(publish_batch(rows, ["n"])).first()
    assert (event.id, event.typeCode, event.road) == ("a", "2", "x")


def test_messages_are_json_a_loop_can_read(spark):
    rng = random.Random(9)
    documents = [random_document(rng) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(documents)), "n int, payload string")
    messages = to_messages(flatten_incidents(new_incidents(rows, ["n"])))
    found = [json.loads(r.value) for r in messages.collect()]
    expected = loop(documents)
    assert len(found) == len(expected)
    assert {json.dumps(e, sort_keys=True) for e in found} == {
        json.dumps(e, sort_keys=True) for e in expected
    }


def test_first_per_key_with_a_key_holding_a_third(spark):
    rng = random.Random(4)
    rows = [(("hot" if n % 3 == 0 else f"k{n % 50}"), rng.randrange(10**6), n) for n in range(6000)]
    frame = spark.createDataFrame(rows, "key string, at int, n int").repartition(16)
    found = {r.key: (r.at, r.n) for r in first_per_key(frame, ["key"], ["at", "n"]).collect()}
    expected = {}
    for key, at, n in rows:
        expected[key] = min(expected.get(key, (at, n)), (at, n))
    assert found == expected


def test_first_per_key_takes_null_as_a_key_and_sorts_null_first(spark):
    frame = spark.createDataFrame([(None, 1), (None, None), ("a", 2)], "key string, at int")
    found = first_per_key(frame, ["key"], [F.col("at")]).collect()
    assert {(r.key, r.at) for r in found} == {(None, None), ("a", 2)}

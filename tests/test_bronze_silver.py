from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import event_time
from roadpulse.operators import normalize, parse_events, split_malformed
from roadpulse.schemas import BRONZE, SILVER


def parse(spark, *texts):
    rows = spark.createDataFrame([(text,) for text in texts], "value string")
    return parse_events(rows.select(F.col("value").cast("binary")))


def filled(row):
    return {name: value for name, value in row.asDict().items() if value is not None}


@pytest.fixture(params=["true", "false"], ids=["ansi", "non-ansi"])
def ansi(request, spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


# Text of a message -> the columns that are not null.
MESSAGES = [
    (
        '{"trafficModelId":"m","id":"i","typeCode":8,"delaySeconds":5,'
        '"position":{"x":-122.4,"y":37.7},'
        '"_raw":{"st":"2024-01-01T00:00:00Z","p":{"x":1},"l":[1,2],"n":null}}',
        {
            "trafficModelId": "m",
            "id": "i",
            "typeCode": "8",
            "delaySeconds": 5,
            "position": {"x": "-122.4", "y": "37.7"},
            "_raw": {"st": "2024-01-01T00:00:00Z", "p": '{"x":1}', "l": "[1,2]", "n": None},
            "event_ts": datetime.datetime(2024, 1, 1),
        },
    ),
    ('{"id":"i"', {}),
    ('{"id":"i","delaySeconds":3,"_raw":{"st":', {"id": "i", "delaySeconds": 3}),
    ("", {}),
    (None, {}),
    ("null", {}),
    ("5", {}),
    ('[{"id":"a"},{"id":"b"}]', {}),
    ('{"id":"i","typeCode":8.5,"delaySeconds":12.7}', {"id": "i", "typeCode": "8.5"}),
    ('{"id":"i","typeCode":true,"delaySeconds":"12"}', {"id": "i", "typeCode": "true"}),
    ('{"id":"i","delaySeconds":3000000000}', {"id": "i"}),
    ('{"id":"i","position":null,"extra":1}', {"id": "i"}),
    ('{"id":"i","typeCode":"z","position":[1,2]}', {"id": "i", "typeCode": "z"}),
    ('{"id":{"a":1}}', {"id": '{"a":1}'}),
    ('{"id":"a","id":"b"}', {"id": "b"}),
    ('{"ID":"a"}', {}),
]


@pytest.mark.parametrize("text, expected", MESSAGES)
def test_parse(spark, ansi, text, expected):
    assert filled(parse(spark, text).first()) == expected


def test_parse_keeps_one_row_per_message(spark):
    texts = [text for text, _ in MESSAGES]
    assert parse(spark, *texts).count() == len(texts)


def test_broken_off_message_reads_the_same_whichever_columns_are_used(spark):
    parsed = parse(spark, '{"id":"i","delaySeconds":3,"_raw":{"st":')
    assert parsed.select("id").first().id == "i"
    assert parsed.where("id is null").count() == 0


TIMES = [
    ("2024-01-01T00:00:00Z", "2024-01-01 00:00:00"),
    ("2024-01-01T00:00:00+01", "2023-12-31 23:00:00"),
    ("2024-01-01T00:00:00+0130", "2023-12-31 22:30:00"),
    ("2024-01-01T00:00:00+01:30", None),
    ("2024-01-01T00:00:00.123Z", None),
    ("2024-01-01T00:00:00", None),
    ("2024-01-01 00:00:00Z", None),
    ("", None),
    ("junk", None),
    ("2024-02-30T00:00:00Z", None),
    (None, None),
]


@pytest.mark.parametrize("text, expected", TIMES)
def test_event_time(spark, ansi, text, expected):
    rows = spark.createDataFrame([({"st": text},)], "raw map<string,string>")
    found = rows.select(event_time("raw").cast("string")).first()[0]
    assert found == expected


def test_event_time_of_a_missing_key_or_map(spark, ansi):
    rows = spark.createDataFrame([({"x": "1"},), (None,)], "raw map<string,string>")
    assert [r[0] for r in rows.select(event_time("raw")).collect()] == [None, None]


def test_split_malformed(spark):
    """Malformed is what is no JSON object to its end; an object without id is readable."""
    texts = ['{"id":"i"}', "{}", '{"typeCode":8}', "junk", '{"id":"a"', '{"id":"a","_raw":{"st":', "null"]
    texts += ["5", '[{"id":"a"}]', "", None]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    usable, malformed = split_malformed(messages.withColumn("value", messages.value.cast("binary")))
    read = [None if r.value is None else bytes(r.value).decode() for r in usable.collect()]
    lost = [None if r.value is None else bytes(r.value).decode() for r in malformed.collect()]
    assert read == texts[:3] and lost == texts[3:]


def bronze(spark, *times):
    rows = spark.createDataFrame([(text,) for text in times], "t string")
    columns = [
        F.col("t").cast("timestamp").alias(f.name)
        if f.name == "event_ts"
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in BRONZE
    ]
    return rows.select(columns)


def test_silver_columns(spark):
    clean = normalize(bronze(spark, "2024-01-01 23:59:59"))
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in SILVER]
    assert clean.first().event_date == datetime.date(2024, 1, 1)


def test_missing_time_takes_one_processing_time(spark):
    stamped = normalize(bronze(spark, None, None, "2024-01-01 00:00:00")).collect()
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    filled_in = {r.event_ts for r in stamped if r.event_ts.year != 2024}
    assert len(filled_in) == 1
    assert abs(now - filled_in.pop()) < datetime.timedelta(minutes=5)


def test_missing_time_modes(spark):
    rows = bronze(spark, None, "2024-01-01 00:00:00")
    kept = normalize(rows, missing_time="null")
    assert sorted(str(r.event_date) for r in kept.collect()) == ["2024-01-01", "None"]
    assert normalize(rows, missing_time="drop").count() == 1
    with pytest.raises(ValueError):
        normalize(rows, missing_time="later")


def test_malformed_message_becomes_a_stamped_row_by_default(spark):
    row = normalize(parse(spark, "junk")).first()
    assert row.incident_id is None and row.event_ts is not None


def test_day_follows_the_session_zone(spark):
    rows = bronze(spark, "2024-01-02T02:00:00Z")
    assert str(normalize(rows).first().event_date) == "2024-01-02"
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert str(normalize(rows).select("event_date").first()[0]) == "2024-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_closed_windows_by_a_given_time(spark):
    from roadpulse.operators import aggregate_windows, closed_only

    rows = spark.sql(
        "select '8' as typeCode, 'r' as road, 1 as delay_seconds, "
        "timestamp '2024-01-01' + make_dt_interval(0, 0, cast(id as int)) as event_ts from range(60)"
    )
    windows = aggregate_windows(rows)
    read = closed_only(windows, rows)
    given = closed_only(windows, latest=F.lit("2024-01-01 00:59:00").cast("timestamp"))
    assert sorted(read.collect()) == sorted(given.collect()) and read.count() == 2
    with pytest.raises(ValueError):
        closed_only(windows)

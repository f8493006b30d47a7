"""Incident-shaped inputs made by Spark from the whole ``events`` table.

The tables hold no incident feed, so each event is read as one incident. Rows that are
missing something, repeated or unreadable are derived by the remainder of ``event_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions import first_label, json_message


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``event_ts`` as an instant; the file holds times without a zone."""
    return _timed(spark.read.parquet(f"{sf_dir}/events.parquet"))


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a file stream: one file, or a folder of parts."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    reader = spark.readStream.schema(table.schema).option("maxFileAge", "36500d")
    # A stream reads folders; a table that is one file is found in its own by name.
    if any(name.rsplit("/", 1)[-1] == "events.parquet" for name in table.inputFiles()):
        return _timed(reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir))
    return _timed(reader.parquet(f"{sf_dir}/events.parquet"))


def _timed(events: DataFrame) -> DataFrame:
    return events.withColumn("event_ts", F.col("ts").cast("timestamp"))


def silver_like(events: DataFrame) -> DataFrame:
    """Each event as a row of the clean table."""
    label = first_label(_road(), _from(), _to())
    return events.select(
        F.col("event_id").cast("string").alias("incident_id"),
        _model().alias("model_id"),
        F.col("event_type").alias("typeCode"),
        (F.col("user_id") % 4).cast("string").alias("iconCode"),
        F.lit(None).cast("string").alias("description"),
        F.col("props").alias("comment"),
        _from().alias("from"),
        _to().alias("to"),
        _road().alias("road"),
        _delay().alias("delay_seconds"),
        _position_texts().alias("position"),
        label.alias("area_hint"),
        "event_ts",
        F.to_date("event_ts").alias("event_date"),
    )


def bronze_like(events: DataFrame) -> DataFrame:
    """Each event as a row of the parsed table; every tenth has no event time."""
    raw = F.create_map(F.lit("st"), F.col("ts").cast("string"))
    return events.select(
        "event_id",
        _model().alias("trafficModelId"),
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("typeCode"),
        (F.col("user_id") % 4).cast("string").alias("iconCode"),
        F.lit(None).cast("string").alias("description"),
        F.col("props").alias("comment"),
        _from().alias("from"),
        _to().alias("to"),
        _road().alias("road"),
        _delay().alias("delaySeconds"),
        _position_texts().alias("position"),
        first_label(_road(), _from(), _to()).alias("area_hint"),
        raw.alias("_raw"),
        F.when(F.col("event_id") % 10 != 0, F.col("event_ts")).alias("event_ts"),
    )


def wire_messages(events: DataFrame, *keep: str) -> DataFrame:
    """Each event as a JSON message, ``value`` as bytes."""
    return events.select(*keep, _wire_text().cast("binary").alias("value"))


def broken_messages(events: DataFrame, *keep: str) -> DataFrame:
    """Messages of which some cannot be read, in part or at all."""
    turn = F.col("event_id") % 20
    identity = F.concat(F.lit('{"id":"'), F.col("event_id"), F.lit('"'))
    text = (
        F.when(turn == 0, F.lit(""))
        .when(turn == 1, F.lit("null"))
        .when(turn == 2, identity)
        .when(turn == 3, F.concat(identity, F.lit(',"delaySeconds":3,"_raw":{"st":')))
        .when(turn == 4, F.concat(identity, F.lit(',"typeCode":8.5,"delaySeconds":12.7}')))
        .when(turn == 5, F.concat(identity, F.lit(',"typeCode":true,"delaySeconds":"12"}')))
        .when(turn == 6, F.concat(identity, F.lit(',"delaySeconds":3000000000}')))
        .when(turn == 7, F.concat(identity, F.lit(',"typeCode":"z","position":[1,2]}')))
        .when(turn == 8, F.concat(identity, F.lit(',"_raw":{"st":"junk"},"more":{"x":1}}')))
        .when(turn == 9, F.concat(F.lit('{"ID":"'), F.col("event_id"), F.lit('"}')))
        .when(turn == 10, F.lit(None).cast("string"))
        .when(turn == 11, F.concat(F.lit("["), identity, F.lit("}]")))
        .otherwise(_wire_text())
    )
    return events.select(*keep, text.cast("binary").alias("value"))


def snapshot_documents(events: DataFrame, *keep: str) -> DataFrame:
    """One snapshot document per event: the event itself, a repeat, and two without id.

    The repeat is one incident for ten events, or for every third event one incident per
    model, so that single keys are hot. Its copies differ in description, type, delay and time.
    ``polled`` numbers the documents. Some documents have no model id, no incidents or no model,
    and some are not JSON.
    """
    number = F.col("event_id")
    own = _incident(
        id=number.cast("string"),
        ty=F.col("event_type"),
        ic=F.col("user_id") % 4,
        d=F.concat(F.lit("event "), number),
        c=F.col("props"),
        f=_from(),
        t=_to(),
        r=_road(),
        dl=_delay(),
        p=_position(),
        st=F.when(number % 10 != 0, _st()),
    )
    repeat = _incident(
        id=F.when(number % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("block-"), F.floor(number / 10))
        ),
        ty=F.concat(F.lit("repeat-"), number % 5),
        d=F.concat(F.lit("seen by "), number),
        t=F.lit("everywhere"),
        dl=number % 97,
        # Within the hour from noon of 15 January 2024.
        st=F.date_format(
            F.timestamp_seconds(F.lit(1705320000) + number % 60 * 60), "yyyy-MM-dd'T'HH:mm:ss'Z'"
        ),
    )
    empty_id = _incident(id=F.lit(""), ty=F.lit("dropped"))
    without_id = _incident(ty=F.lit("dropped"))
    model = F.struct(
        F.when(number % 17 != 0, _model()).alias("@id"),
        F.when(number % 11 != 0, F.array(own, repeat, empty_id, without_id)).alias("poi"),
    )
    document = F.to_json(
        F.struct(number.alias("polled"), F.when(number % 13 != 0, model).alias("tm"))
    )
    return events.select(
        *keep, F.when(number % 19 == 0, F.lit("not json")).otherwise(document).alias("payload")
    )


def _incident(**given: Column) -> Column:
    types = {"ic": "bigint", "dl": "int", "p": "struct<x:bigint,y:double>"}
    names = ["id", "ty", "ic", "d", "c", "f", "t", "r", "dl", "p", "st"]
    return F.struct(
        *[
            given.get(name, F.lit(None)).cast(types.get(name, "string")).alias(name)
            for name in names
        ]
    )


def _wire_text() -> Column:
    return json_message(
        _model().alias("trafficModelId"),
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("typeCode"),
        (F.col("user_id") % 4).alias("iconCode"),
        F.lit(None).cast("string").alias("description"),
        F.col("props").alias("comment"),
        _from().alias("from"),
        _to().alias("to"),
        _road().alias("road"),
        _delay().alias("delaySeconds"),
        _position().alias("position"),
        first_label(_road(), _from(), _to()).alias("area_hint"),
        F.struct(
            _st().alias("st"), F.col("event_id").cast("string").alias("id"), _delay().alias("dl")
        ).alias("_raw"),
    )


def _st() -> Column:
    return F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _model() -> Column:
    return F.concat(F.lit("m"), F.col("user_id") % 7)


def _from() -> Column:
    street = F.concat(F.lit("from-"), F.col("user_id") % 11)
    return F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(street)


def _to() -> Column:
    return F.concat(F.lit("to-"), F.col("user_id") % 13)


def _road() -> Column:
    """Null for every fifth user."""
    return F.when(
        F.col("user_id") % 5 != 0, F.concat(F.lit("road-"), F.col("user_id") % 5)
    )


def _delay() -> Column:
    return F.col("value").cast("int")


def _position() -> Column:
    return F.struct(F.col("user_id").alias("x"), F.col("value").alias("y"))


def _position_texts() -> Column:
    return F.create_map(
        F.lit("x"), F.col("user_id").cast("string"), F.lit("y"), F.col("value").cast("string")
    )

"""The operators on whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.catalog import sql
from roadpulse.catalog.registry import query
from roadpulse.config import FeedConfig
from roadpulse.functions import (
    event_date,
    event_time,
    first_label,
    incident_key,
    tumbling,
)
from roadpulse.operators import (
    aggregate_windows,
    closed_only,
    clustered_by_place,
    coordinates,
    explode_snapshots,
    first_per_key,
    flatten_incidents,
    incidents_per_snapshot,
    message_of_event,
    normalize,
    parse_events,
    split_malformed,
    to_messages,
    watermarked,
    with_id,
    within_bbox,
    within_bbox_clustered,
)
from roadpulse.plans import (
    clean_table,
    gold_table,
    new_incidents,
    publish_batch,
    snapshots_to_gold,
)
from roadpulse.plans.derived import (
    bronze_like,
    broken_messages,
    read_events,
    silver_like,
    snapshot_documents,
    wire_messages,
)
from roadpulse.schemas import SILVER
from roadpulse.session import new_work_dir
from roadpulse.sinks import write_messages, write_table
from roadpulse.sources import read_messages, read_snapshots, read_table


def _clock() -> Column:
    """Stands in for the processing time, so that a run can be repeated."""
    return F.lit("2024-02-01T00:00:00Z").cast("timestamp")



def _pairs(position: str = "position") -> list[Column]:
    return [
        F.col(position)["x"].try_cast("double").alias("lon"),
        F.col(position)["y"].try_cast("double").alias("lat"),
    ]


# ---------------------------------------------------------------- snapshots


@query(
    f"""
    with {sql.EXPLODED}
    select event_id, pos as position_in_snapshot, model as model_id, id, ty, ic, d, c, f, t, r,
           dl, st, lon, lat
    from exploded
    """
)
def snapshot_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode documents and explode their incidents, unknown keys included."""
    documents = snapshot_documents(read_events(spark, sf_dir), "event_id")
    return explode_snapshots(documents).select(
        "event_id",
        "position_in_snapshot",
        F.col("trafficModelId").alias("model_id"),
        "incident.id",
        *[F.col("_raw")[name].alias(name) for name in ("ty", "ic", "d", "c", "f", "t", "r")],
        "incident.dl",
        F.col("_raw")["st"].alias("st"),
        *_pairs("incident.p"),
    )


@query(
    f"""
    with {sql.EXPLODED}
    select event_id, model as "trafficModelId", id, ty as "typeCode", ic as "iconCode",
           d as description, c as comment, f as "from", t as "to", r as road,
           dl as "delaySeconds", lon, lat,
           coalesce(nullif(r, ''), nullif(f, ''), t) as area_hint,
           id as raw_id, st as raw_st, cast(dl as varchar) as raw_dl
    from exploded where id <> ''
    """
)
def flatten_incident(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat event columns; absent keys are null, incidents without id are gone."""
    documents = snapshot_documents(read_events(spark, sf_dir), "event_id")
    events = flatten_incidents(with_id(explode_snapshots(documents)), "event_id")
    return events.select(
        *[name for name in events.columns if name not in ("position", "_raw")],
        *_pairs(),
        F.col("_raw")["id"].alias("raw_id"),
        F.col("_raw")["st"].alias("raw_st"),
        F.col("_raw")["dl"].alias("raw_dl"),
    )


@query(
    f"""
    with {sql.DOCUMENTS}
    select event_id, cast(case when readable then 4 else 0 end as int) as incidents
    from documents_of_events
    """
)
def incidents_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents in each snapshot before any is dropped."""
    return incidents_per_snapshot(snapshot_documents(read_events(spark, sf_dir), "event_id"))


@query(
    f"""
    with {sql.DOCUMENTS}
    select user_id % 7 as poll, count(*) as snapshots,
           cast(sum(case when readable then 4 else 0 end) as bigint) as incidents
    from documents_of_events group by 1
    """
)
def incidents_per_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same count added up over groups of snapshots."""
    documents = snapshot_documents(
        read_events(spark, sf_dir), (F.col("user_id") % 7).alias("poll")
    )
    return (
        incidents_per_snapshot(documents)
        .groupBy("poll")
        .agg(F.count("*").alias("snapshots"), F.sum("incidents").alias("incidents"))
    )


@query(
    f"""
    with {sql.EXPLODED}
    select model as model_id, id, ty as type_code, d as description, dl as delay_seconds,
           coalesce(nullif(r, ''), nullif(f, ''), t) as area_hint,
           sha256(model || ':' || id) as key, event_id as first_seen
    from exploded where id <> ''
    qualify row_number() over (partition by model, id order by event_id, pos) = 1
    """
)
def new_incident(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First copy of each incident under each model, hot keys included."""
    documents = snapshot_documents(read_events(spark, sf_dir), "event_id")
    first = new_incidents(documents, ["event_id"])
    return flatten_incidents(first, "key", "event_id").select(
        F.col("trafficModelId").alias("model_id"),
        "id",
        F.col("typeCode").alias("type_code"),
        "description",
        F.col("delaySeconds").alias("delay_seconds"),
        "area_hint",
        "key",
        F.col("event_id").alias("first_seen"),
    )


@query(
    """
    select event_id, coalesce(nullif(a, ''), nullif(b, ''), c) as area_hint
    from (select event_id,
                 case when user_id % 5 <> 0 then 'road-' || (user_id % 5) end as a,
                 case when event_id % 3 = 0 then '' else 'from-' || (user_id % 11) end as b,
                 case when event_id % 2 = 0 then '' else 'to-' || (user_id % 13) end as c
          from events)
    """
)
def area_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Road, else start, else end; the last one may be empty."""
    labels = read_events(spark, sf_dir).selectExpr(
        "event_id",
        "case when user_id % 5 <> 0 then concat('road-', user_id % 5) end as a",
        "case when event_id % 3 = 0 then '' else concat('from-', user_id % 11) end as b",
        "case when event_id % 2 = 0 then '' else concat('to-', user_id % 13) end as c",
    )
    return labels.select("event_id", first_label("a", "b", "c").alias("area_hint"))


@query(
    """
    select event_id,
           sha256(concat(case when event_id % 4 <> 0 then event_type else '' end, ':',
                         cast(event_id as varchar))) as key
    from events
    """
)
def key_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of model and id; a missing model counts as empty text."""
    model = F.when(F.col("event_id") % 4 != 0, F.col("event_type"))
    return read_events(spark, sf_dir).select(
        "event_id", incident_key(model, F.col("event_id").cast("string")).alias("key")
    )


@query(
    """
    select event_id, ts, user_id, event_type, value from events
    qualify row_number() over (partition by event_type, user_id order by ts, event_id) = 1
    """
)
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row per key of a table."""
    events = read_events(spark, sf_dir).select(
        "event_id", "ts", "user_id", "event_type", "value"
    )
    return first_per_key(events, ["event_type", "user_id"], ["ts", "event_id"])


@query(
    """
    select event_type, min(event_id) as event_id, arg_min(props, event_id) as props
    from events group by 1
    """
)
def dedup_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row per key where a handful of keys hold the whole table."""
    events = read_events(spark, sf_dir).select("event_type", "event_id", "props")
    return first_per_key(events, ["event_type"], ["event_id"])


@query(
    """
    select event_id, cast(user_id as double) as lon, value as lat
    from events where user_id between 10 and 60 and value between 5 and 50
    """
)
def bbox_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents inside a box, from coordinates held as text in a map."""
    incidents = silver_like(read_events(spark, sf_dir))
    inside = within_bbox(incidents, (10.0, 5.0, 60.0, 50.0))
    return inside.select(F.col("incident_id").cast("bigint").alias("event_id"), *_pairs())


@query(
    """
    select event_id, cast(user_id as double) as lon, value as lat
    from events where user_id between 10 and 60 and value between 5 and 50
    """
)
def bbox_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a table of incidents clustered by place, of which the scan skips what is far."""
    incidents = coordinates(silver_like(read_events(spark, sf_dir)))
    extent = incidents.agg(F.min("lon"), F.min("lat"), F.max("lon"), F.max("lat")).first()
    path = new_work_dir(spark, "bbox_clustered")
    clustered_by_place(incidents, extent).write.partitionBy("event_date").parquet(path)
    inside = within_bbox_clustered(spark.read.parquet(path), (10.0, 5.0, 60.0, 50.0), extent)
    return inside.select(F.col("incident_id").cast("bigint").alias("event_id"), "lon", "lat")


# ---------------------------------------------------------------- wire and bronze


@query(
    f"""
    with {sql.EVENT_COLUMNS}
    select event_id, model as model_id, cast(event_id as varchar) as id, event_type as type_code,
           cast(user_id % 4 as varchar) as icon_code, props as comment, from_street, to_street,
           road, delay_seconds, area_hint, 13 as keys, road is null as road_is_json_null
    from incident_columns
    """
)
def wire_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as JSON text; every key is present, nulls included."""
    events = bronze_like(read_events(spark, sf_dir))
    messages = events.select("event_id", message_of_event().alias("value"))
    wire = {
        "trafficModelId": "model_id",
        "id": "id",
        "typeCode": "type_code",
        "iconCode": "icon_code",
        "comment": "comment",
        "from": "from_street",
        "to": "to_street",
        "road": "road",
        "delaySeconds": "delay_seconds",
        "area_hint": "area_hint",
    }
    return messages.select(
        "event_id",
        F.json_tuple("value", *wire).alias(*wire.values()),
        F.size(F.json_object_keys("value")).alias("keys"),
        F.col("value").contains('"road":null').alias("road_is_json_null"),
    ).withColumn("delay_seconds", F.col("delay_seconds").cast("int"))


@query(
    f"""
    with {sql.EXPLODED}
    select model as model_id, id, 'STRING' as type_code,
           case when ic is null then 'VOID' else 'BIGINT' end as icon_code, 'BIGINT' as delay_seconds,
           case when lat is null then 'VOID' else 'OBJECT' end as position,
           case when lat is null then 'VOID' else 'OBJECT' end as raw_position,
           case when lon is not null then 'BIGINT' end as raw_longitude
    from exploded where id <> ''
    qualify row_number() over (partition by model, id order by event_id, pos) = 1
    """
)
def wire_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON types of published values: those of the snapshot, nested ones included."""
    documents = snapshot_documents(read_events(spark, sf_dir), "event_id")
    message = publish_batch(documents, ["event_id"]).select(F.parse_json("value").alias("m"))

    def kind(path: str) -> Column:
        found = F.schema_of_variant(F.variant_get("m", path, "variant"))
        return F.regexp_extract(found, "^[A-Z]+", 0)

    return message.select(
        F.variant_get("m", "$.trafficModelId", "string").alias("model_id"),
        F.variant_get("m", "$.id", "string").alias("id"),
        kind("$.typeCode").alias("type_code"),
        kind("$.iconCode").alias("icon_code"),
        kind("$.delaySeconds").alias("delay_seconds"),
        kind("$.position").alias("position"),
        F.coalesce(kind("$._raw.p"), F.lit("VOID")).alias("raw_position"),
        kind("$._raw.p.x").alias("raw_longitude"),
    )


@query(
    f"""
    with {sql.EVENT_COLUMNS}
    select event_id, model as "trafficModelId", cast(event_id as varchar) as id,
           event_type as "typeCode", cast(user_id % 4 as varchar) as "iconCode",
           cast(null as varchar) as description, props as comment, from_street as "from",
           to_street as "to", road, delay_seconds as "delaySeconds", area_hint,
           cast(user_id as double) as lon, value as lat,
           cast(delay_seconds as varchar) as raw_dl, date_trunc('second', ts) as event_ts
    from incident_columns
    """
)
def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes -> text -> struct -> columns, event time from the raw map."""
    parsed = parse_events(wire_messages(read_events(spark, sf_dir)))
    return parsed.select(
        F.col("id").cast("bigint").alias("event_id"),
        *[name for name in parsed.columns if name not in ("position", "_raw")],
        *_pairs(),
        F.col("_raw")["dl"].alias("raw_dl"),
    )


@query(
    f"""
    with {sql.BROKEN}
    select id, "typeCode", "delaySeconds", position_missing, event_ts, count(*) as n
    from broken group by all
    """
)
def bronze_parse_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable messages flow on as nulls, ill-typed fields alone become null."""
    parsed = parse_events(broken_messages(read_events(spark, sf_dir)))
    return parsed.groupBy(
        "id",
        "typeCode",
        "delaySeconds",
        F.col("position").isNull().alias("position_missing"),
        "event_ts",
    ).agg(F.count("*").alias("n"))


@query(
    f"""
    with {sql.EVENT_COLUMNS}
    select event_id, event_id % 20 in (0, 1, 2, 3, 10, 11) as malformed,
           case event_id % 20
               when 0 then '' when 1 then 'null' when 2 then '{{"id":"' || event_id || '"'
               when 3 then '{{"id":"' || event_id || '","delaySeconds":3,"_raw":{{"st":'
               when 11 then '[{{"id":"' || event_id || '"}}]' end as kept_text
    from incident_columns
    """
)
def malformed_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable and unreadable messages apart, the text of the latter kept."""
    messages = broken_messages(read_events(spark, sf_dir), "event_id")
    usable, malformed = split_malformed(messages)
    text = F.col("value").cast("string")
    return usable.select(
        "event_id", F.lit(False).alias("malformed"), F.lit(None).cast("string").alias("kept_text")
    ).unionByName(malformed.select("event_id", F.lit(True).alias("malformed"), text.alias("kept_text")))


@query(
    """
    select event_id, json_extract_string(props, '$.k') as k, cast(null as varchar) as missing
    from events
    """
)
def map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value of a key in a text map; an absent key gives null."""
    props = F.from_json("props", "map<string,string>")
    return read_events(spark, sf_dir).select(
        "event_id", props["k"].alias("k"), props["absent"].alias("missing")
    )


@query(
    """
    select event_id,
           case event_id % 8
               when 0 then date_trunc('second', ts)
               when 1 then date_trunc('second', ts) - interval 1 hour
               when 2 then date_trunc('second', ts) - interval 90 minute
           end as event_ts
    from events
    """
)
def event_time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to timestamp; whatever does not fit the pattern is null."""
    events = read_events(spark, sf_dir)
    seconds = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss")
    turn = F.col("event_id") % 8
    text = (
        F.when(turn == 0, F.concat(seconds, F.lit("Z")))
        .when(turn == 1, F.concat(seconds, F.lit("+01")))
        .when(turn == 2, F.concat(seconds, F.lit("+0130")))
        .when(turn == 3, F.concat(seconds, F.lit("+01:30")))
        .when(turn == 4, F.concat(seconds, F.lit(".123Z")))
        .when(turn == 5, seconds)
        .when(turn == 6, F.lit("2024-02-30T00:00:00Z"))
    )
    raw = F.create_map(F.lit("st"), text)
    return events.select("event_id", event_time(raw).alias("event_ts"))


# ---------------------------------------------------------------- silver


@query(
    f"""
    with {sql.EVENT_COLUMNS}
    select cast(event_id as varchar) as incident_id, model as model_id,
           event_type as "typeCode", cast(user_id % 4 as varchar) as "iconCode",
           cast(null as varchar) as description, props as comment, from_street as "from",
           to_street as "to", road, delay_seconds, area_hint,
           coalesce(case when event_id % 10 <> 0 then ts end, timestamp '2024-02-01') as event_ts,
           cast(coalesce(case when event_id % 10 <> 0 then ts end, timestamp '2024-02-01') as date)
               as event_date,
           cast(user_id as double) as lon, value as lat
    from incident_columns
    """
)
def silver_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean columns; a row without event time takes the clock."""
    clean = normalize(bronze_like(read_events(spark, sf_dir)), clock=_clock())
    return clean.select(*[name for name in clean.columns if name != "position"], *_pairs())


@query(
    """
    select event_id % 10 <> 0 as timed, count(*) as rows_null_mode,
           count(case when event_id % 10 <> 0 then ts end) as timed_rows,
           count(case when event_id % 10 <> 0 then cast(ts as date) end) as dated_rows
    from events group by 1
    """
)
def silver_missing_time_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without event time kept as they are."""
    clean = normalize(bronze_like(read_events(spark, sf_dir)), missing_time="null")
    return clean.groupBy(F.col("event_ts").isNotNull().alias("timed")).agg(
        F.count("*").alias("rows_null_mode"),
        F.count("event_ts").alias("timed_rows"),
        F.count("event_date").alias("dated_rows"),
    )


@query(
    """
    select cast(event_id as varchar) as incident_id, ts as event_ts, cast(ts as date) as event_date
    from events where event_id % 10 <> 0
    """
)
def silver_missing_time_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without event time removed."""
    clean = normalize(bronze_like(read_events(spark, sf_dir)), missing_time="drop")
    return clean.select("incident_id", "event_ts", "event_date")


@query("select event_id, cast(ts as date) as event_date from events")
def event_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar day of an instant."""
    return read_events(spark, sf_dir).select(
        "event_id", event_date("event_ts").alias("event_date")
    )


@query(
    f"""
    with {sql.EVENT_COLUMNS}
    select cast(ts as date) as event_date, count(*) as n, count(road) as with_road,
           cast(sum(delay_seconds) as bigint) as delay_seconds
    from incident_columns group by 1
    """
)
def silver_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table written with one folder per day, and read back."""
    config = FeedConfig.under(new_work_dir(spark, "silver_partitions"))
    write_table(
        silver_like(read_events(spark, sf_dir)),
        config.silver_table,
        config,
        partition_by=["event_date"],
    )
    return (
        read_table(spark, config.silver_table, SILVER, config)
        .groupBy("event_date")
        .agg(
            F.count("*").alias("n"),
            F.count("road").alias("with_road"),
            F.sum("delay_seconds").alias("delay_seconds"),
        )
    )


# ---------------------------------------------------------------- gold


@query(
    """
    select event_id, time_bucket(interval 10 minute, ts) as window_start,
           time_bucket(interval 10 minute, ts) + interval 10 minute as window_end
    from events
    """
)
def time_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling window of each row, its struct taken apart."""
    windows = read_events(spark, sf_dir).select(
        "event_id", tumbling("event_ts", "10 minutes").alias("w")
    )
    return windows.select(
        "event_id",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
    )


@query(f"with {sql.GOLD} select * from gold")
def gold_10m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and mean delay per window, type and road; a null road is a group."""
    return gold_table(silver_like(read_events(spark, sf_dir)))


@query(
    f"""
    with {sql.GOLD}
    select * from gold
    where window_end <= (select max(event_ts) - interval 30 minute from incidents)
    """
)
def gold_10m_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only what a stream in append mode would have emitted by now."""
    clean = watermarked(silver_like(read_events(spark, sf_dir)))
    return closed_only(aggregate_windows(clean), clean)


@query(
    """
    select time_bucket(interval 1 hour, ts) as window_start,
           time_bucket(interval 1 hour, ts) + interval 1 hour as window_end,
           event_type as kind, count(*) as event_count,
           avg(cast(trunc(value) as int)) as avg_delay_seconds
    from events group by 1, 2, 3
    """
)
def gold_hourly_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another window length and other keys."""
    clean = silver_like(read_events(spark, sf_dir))
    return aggregate_windows(clean, "1 hour", keys={"kind": "typeCode"})


@query(
    f"""
    with {sql.EVENT_COLUMNS}
    select time_bucket(interval 10 minute, ts) as window_start,
           time_bucket(interval 10 minute, ts) + interval 10 minute as window_end,
           event_type as type_code, road, count(*) as event_count,
           avg(case when event_id % 6 < 4 then delay_seconds end) as avg_delay_seconds
    from incident_columns where event_id % 10 <> 0 group by 1, 2, 3, 4
    """
)
def gold_missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without time are left out, missing delays are counted but not averaged."""
    delay = F.when(F.col("event_id") % 6 < 4, F.col("delaySeconds"))
    bronze = bronze_like(read_events(spark, sf_dir)).withColumn("delaySeconds", delay)
    return gold_table(normalize(bronze, missing_time="null"))


# ---------------------------------------------------------------- stages as batch plans


@query(
    f"""
    with {sql.GOLD_OF_MESSAGES}
    select * from gold
    """
)
def wire_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to gold in one plan."""
    return gold_table(clean_table(wire_messages(read_events(spark, sf_dir)), clock=_clock()))


@query(f"with {sql.GOLD_OF_SNAPSHOTS} select * from gold")
def snapshot_messages_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots to gold by way of the JSON messages."""
    documents = snapshot_documents(read_events(spark, sf_dir), "event_id")
    return gold_table(clean_table(publish_batch(documents, ["event_id"]), clock=_clock()))


@query(f"with {sql.GOLD_OF_SNAPSHOTS} select * from gold")
def snapshot_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots to gold in one plan: explode, dedup, flatten, clean, count."""
    documents = snapshot_documents(read_events(spark, sf_dir), "event_id")
    return snapshots_to_gold(documents, ["event_id"], clock=_clock())


@query(
    f"""
    with {sql.EXPLODED}
    select model as model_id, ty as type_code, count(*) as n, count(distinct id) as incidents,
           cast(sum(dl) as bigint) as delay_seconds
    from exploded where id <> '' group by 1, 2
    """
)
def message_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed as text, read back, published as message files, and parsed."""
    config = FeedConfig.under(new_work_dir(spark, "message_files"), whole_files=False)
    documents = snapshot_documents(read_events(spark, sf_dir))
    documents.write.text(config.snapshot_path)
    incidents = with_id(explode_snapshots(read_snapshots(spark, config)))
    write_messages(to_messages(flatten_incidents(incidents)), config)
    return (
        parse_events(read_messages(spark, config))
        .groupBy(F.col("trafficModelId").alias("model_id"), F.col("typeCode").alias("type_code"))
        .agg(
            F.count("*").alias("n"),
            F.countDistinct("id").alias("incidents"),
            F.sum("delaySeconds").alias("delay_seconds"),
        )
    )

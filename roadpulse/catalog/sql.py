"""Common table expressions shared by the SQL twins."""

# Columns of an event read as one incident.
EVENT_COLUMNS = """
incident_columns as (
    select *, coalesce(nullif(road, ''), nullif(from_street, ''), to_street) as area_hint
    from (
        select *, 'm' || (user_id % 7) as model,
               case when event_id % 3 = 0 then '' else 'from-' || (user_id % 11) end as from_street,
               'to-' || (user_id % 13) as to_street,
               case when user_id % 5 <> 0 then 'road-' || (user_id % 5) end as road,
               cast(trunc(value) as int) as delay_seconds
        from events
    )
)
"""

# One snapshot document per event; only the readable ones hold incidents.
DOCUMENTS = f"""
{EVENT_COLUMNS},
documents_of_events as (
    select *, event_id % 19 <> 0 and event_id % 13 <> 0 and event_id % 11 <> 0 as readable,
           case when event_id % 17 <> 0 then model else '' end as snapshot_model
    from incident_columns
)
"""

# The incidents of those documents.
EXPLODED = f"""
{DOCUMENTS},
exploded as (
    select event_id, 0 as pos, snapshot_model as model, cast(event_id as varchar) as id,
           event_type as ty, cast(user_id % 4 as varchar) as ic, 'event ' || event_id as d,
           props as c, from_street as f, to_street as t, road as r, delay_seconds as dl,
           case when event_id % 10 <> 0 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') end as st,
           cast(user_id as double) as lon, value as lat
    from documents_of_events where readable
    union all
    select event_id, 1, snapshot_model,
           case when event_id % 3 = 0 then 'hot' else 'block-' || (event_id // 10) end,
           'repeat-' || (event_id % 5), null, 'seen by ' || event_id, null, null, 'everywhere', null,
           cast(event_id % 97 as int),
           strftime(timestamp '2024-01-15 12:00:00' + to_minutes(cast(event_id % 60 as bigint)),
                    '%Y-%m-%dT%H:%M:%SZ'), null, null
    from documents_of_events where readable
    union all
    select event_id, 2, snapshot_model, '', 'dropped',
           null, null, null, null, null, null, null, null, null, null
    from documents_of_events where readable
    union all
    select event_id, 3, snapshot_model, null, 'dropped',
           null, null, null, null, null, null, null, null, null, null
    from documents_of_events where readable
)
"""

# What parsing makes of messages that are broken in different ways.
BROKEN = f"""
{EVENT_COLUMNS},
broken as (
    select case when turn in (0, 1, 2, 9, 10, 11) then null
                else cast(event_id as varchar) end as id,
           case when turn = 4 then '8.5' when turn = 5 then 'true' when turn = 7 then 'z'
                when turn >= 12 then event_type end as "typeCode",
           case when turn = 3 then 3 when turn >= 12 then delay_seconds end as "delaySeconds",
           turn < 12 as position_missing,
           case when turn >= 12 then date_trunc('second', ts) end as event_ts
    from (select *, event_id % 20 as turn from incident_columns)
)
"""


def gold_of(incidents: str) -> str:
    """Gold over a query giving event_ts, type_code, road and delay_seconds."""
    return f"""
incidents as ({incidents}),
gold as (
    select time_bucket(interval 10 minute, event_ts) as window_start,
           time_bucket(interval 10 minute, event_ts) + interval 10 minute as window_end,
           type_code, road, count(*) as event_count, avg(delay_seconds) as avg_delay_seconds
    from incidents group by 1, 2, 3, 4
)
"""


GOLD = f"""
{EVENT_COLUMNS},
{gold_of("select ts as event_ts, event_type as type_code, road, delay_seconds from incident_columns")}
"""

GOLD_OF_MESSAGES = f"""
{EVENT_COLUMNS},
{gold_of('''
    select date_trunc('second', ts) as event_ts, event_type as type_code, road, delay_seconds
    from incident_columns
''')}
"""

# Snapshots, first copy of each incident, a fixed clock for those without time.
GOLD_OF_SNAPSHOTS = f"""
{EXPLODED},
{gold_of('''
    select coalesce(strptime(st, '%Y-%m-%dT%H:%M:%SZ'), timestamp '2024-02-01') as event_ts,
           ty as type_code, r as road, dl as delay_seconds
    from exploded where id <> ''
    qualify row_number() over (partition by model, id order by event_id, pos) = 1
''')}
"""

# Batch b of the late-data queries: a block of five days, every 50th row one to three late.
LATE_BATCHES = """
batched as (
    select *, time_bucket(interval 10 minute, ts) as w,
           least(5, cast(floor((day(ts) - 1) / 5) as int)
                    + case when event_id % 50 = 0 then cast(event_id % 3 as int) + 1 else 0 end) as b
    from events
),
greatest_time as (select b, max(ts) as m from batched group by b),
watermark as (
    select b, max(m) over (order by b rows between unbounded preceding and 1 preceding)
              - interval 30 minute as wk
    from greatest_time
)
"""

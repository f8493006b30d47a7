"""One definition of each layer's columns. All columns are nullable."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT_MAP = MapType(StringType(), StringType())

# Short key of a raw incident -> column name of the event.
RAW_TO_WIRE = {
    "id": "id",
    "ty": "typeCode",
    "ic": "iconCode",
    "d": "description",
    "c": "comment",
    "f": "from",
    "t": "to",
    "r": "road",
    "dl": "delaySeconds",
    "p": "position",
}

# Columns of the event that are not text.
_WIRE_TYPES = {"delaySeconds": IntegerType(), "position": TEXT_MAP, "_raw": TEXT_MAP}


def _fields(names, types) -> StructType:
    return StructType([StructField(name, types.get(name, StringType())) for name in names])


# The id of a raw incident and its keys that are not text; the others come from its text map.
INCIDENT = StructType(
    [
        StructField(raw, _WIRE_TYPES.get(wire, StringType()))
        for raw, wire in RAW_TO_WIRE.items()
        if raw == "id" or wire in _WIRE_TYPES
    ]
)


def snapshot_of(element) -> StructType:
    """The snapshot document with ``element`` as the type of one incident."""
    model = StructType(
        [StructField("@id", StringType()), StructField("poi", ArrayType(element))]
    )
    return StructType([StructField("tm", model)])


# The thirteen event columns, in order.
WIRE = _fields(
    ["trafficModelId", *RAW_TO_WIRE.values(), "area_hint", "_raw"],
    _WIRE_TYPES,
)

BRONZE = StructType([*WIRE.fields, StructField("event_ts", TimestampType())])

# The columns of the clean table, in order.
SILVER = _fields(
    [
        "incident_id",
        "model_id",
        "typeCode",
        "iconCode",
        "description",
        "comment",
        "from",
        "to",
        "road",
        "delay_seconds",
        "position",
        "area_hint",
        "event_ts",
        "event_date",
    ],
    {
        "delay_seconds": IntegerType(),
        "position": TEXT_MAP,
        "event_ts": TimestampType(),
        "event_date": DateType(),
    },
)

# The columns of the windowed table, in order.
GOLD = _fields(
    ["window_start", "window_end", "type_code", "road", "event_count", "avg_delay_seconds"],
    {
        "window_start": TimestampType(),
        "window_end": TimestampType(),
        "event_count": LongType(),
        "avg_delay_seconds": DoubleType(),
    },
)

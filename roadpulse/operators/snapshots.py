"""Snapshot documents -> one row per incident -> flat events -> messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from roadpulse.functions import first_label, json_message
from roadpulse.schemas import INCIDENT, RAW_TO_WIRE, TEXT_MAP, WIRE, snapshot_of


def explode_snapshots(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per element of ``tm.poi``; every other column of ``documents`` is kept.

    Adds ``trafficModelId`` (empty text where missing), ``position_in_snapshot``, ``_raw``
    (every key as text) and ``incident`` (the id and the keys that are not text). The
    document is read twice on purpose: a map loses the difference between ``12`` and
    ``"12"``, a struct loses unknown keys. The other keys stay in the map until the rows are
    flattened, so that a shuffle in between moves them once. A document without incidents,
    or one that is not JSON, gives no row.
    """
    kept = [name for name in documents.columns if name != payload]
    parsed = documents.select(
        *kept,
        payload,
        F.from_json(payload, snapshot_of(INCIDENT))["tm"].alias("_typed"),
        F.from_json(payload, snapshot_of(TEXT_MAP))["tm"]["poi"].alias("_texts"),
    ).select(
        *kept,
        F.col("_typed.@id").alias("_model"),
        _elements(F.col("_typed.poi"), payload, INCIDENT).alias("incident"),
        _elements(F.col("_texts"), payload, TEXT_MAP).alias("_raw"),
    )
    return parsed.select(
        *kept,
        F.coalesce("_model", F.lit("")).alias("trafficModelId"),
        F.posexplode(F.arrays_zip("incident", "_raw")).alias("position_in_snapshot", "_pair"),
    ).select(*kept, "trafficModelId", "position_in_snapshot", "_pair.incident", "_pair._raw")


def _elements(parsed: Column, payload: str, element: DataType) -> Column:
    """``parsed``, the array read in one go, or its elements read one by one.

    One element that is not an object makes Spark give up the whole array. Then each element
    is read from its own text, so that only the bad one is lost.
    """
    texts = F.from_json(payload, snapshot_of(StringType()))["tm"]["poi"]
    return F.coalesce(parsed, F.transform(texts, lambda text: F.from_json(text, element)))


def explode_texts(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per element of ``tm.poi`` as the JSON text it came as, the document read once.

    Adds ``trafficModelId``, ``position_in_snapshot``, ``text`` and ``incident`` (its id only, as
    text). For plans that drop repeats before they look at the other keys; ``read_texts`` reads
    those of what is left.
    """
    kept = [name for name in documents.columns if name != payload]
    model = F.from_json(payload, snapshot_of(StringType()))["tm"]
    only_id = StructType([StructField("id", StringType())])

    def with_its_id(text: Column) -> Column:
        # Read inside the array, so that a filter on the id does not read the text once more.
        return F.struct(text.alias("text"), F.from_json(text, only_id).alias("incident"))

    # The outer form, and documents without incidents dropped behind it: of the plain one Spark
    # makes a filter on the array, for which it would be built a second time.
    return (
        documents.select(*kept, model.alias("_model"))
        .select(
            *kept,
            F.coalesce("_model.@id", F.lit("")).alias("trafficModelId"),
            F.transform("_model.poi", with_its_id).alias("_elements"),
        )
        .select(
            *kept,
            "trafficModelId",
            F.posexplode_outer("_elements").alias("position_in_snapshot", "_element"),
        )
        .where(F.col("position_in_snapshot").isNotNull())
        .select(*kept, "trafficModelId", "position_in_snapshot", "_element.text", "_element.incident")
    )


def read_texts(incidents: DataFrame) -> DataFrame:
    """Rows of ``explode_texts`` with ``incident`` and ``_raw`` as ``explode_snapshots`` has them."""
    return incidents.withColumn("_raw", F.from_json("text", TEXT_MAP)).withColumn(
        "incident", F.from_json("text", INCIDENT)
    )


def read_position(text: str) -> Column:
    """The position of an incident given as JSON text, as a text map."""
    return F.from_json(text, StructType([StructField("p", TEXT_MAP)]))["p"]


def with_id(incidents: DataFrame) -> DataFrame:
    """Drop incidents whose id is missing or empty.

    One comparison, which a null does not pass: pushed below the reading of the id, each mention
    of it reads the text again.
    """
    return incidents.where(F.col("incident.id") != "")


def flatten_incidents(incidents: DataFrame, *keep: str) -> DataFrame:
    """Event columns of an exploded incident, after any columns named in ``keep``."""

    def value(key: str) -> Column:
        return F.col("incident")[key] if key in INCIDENT.names else F.col("_raw")[key]

    renamed = [value(raw).alias(wire) for raw, wire in RAW_TO_WIRE.items()]
    label = first_label(value("r"), value("f"), value("t")).alias("area_hint")
    return incidents.withColumn("_raw", _last_of_each_key("_raw")).select(
        *keep, "trafficModelId", *renamed, label, "_raw"
    )


def _last_of_each_key(texts: str) -> Column:
    """The map with the last value of a key that its object holds more than once.

    Spark reads such an object as a map with the key in it twice, and a lookup would find
    the first.
    """
    names = F.array_distinct(F.map_keys(texts))
    entries = F.map_entries(texts)

    def last(name: Column) -> Column:
        return F.element_at(F.filter(entries, lambda entry: entry["key"] == name), -1)["value"]

    rebuilt = F.map_from_arrays(names, F.transform(names, last))
    return F.when(F.size(names) < F.size(texts), rebuilt).otherwise(F.col(texts))


def to_messages(events: DataFrame, text: str | None = None) -> DataFrame:
    """One ``value`` text per event. No key: the broker spreads the messages.

    With the ``text`` of the incident every value keeps the JSON type it came with, and ``_raw``
    is the incident itself. Without, or where an object holds a key twice, numbers and nested
    values are texts; the parsed table is the same either way.
    """
    if text is None:
        return events.select(message_of_event().alias("value"))
    rows = _with_typed_message(events, text)
    return rows.select(F.coalesce(_TYPED, message_of_event()).alias("value"))


def messages_of_texts(incidents: DataFrame) -> DataFrame:
    """``to_messages`` of rows of ``explode_texts``, their ``text`` read once.

    The columns of the event are made only for texts that give no typed message.
    """
    typed = _with_typed_message(incidents.select("trafficModelId", "text"), "text")
    untyped = typed.withColumn("text", F.when(F.col(_TYPED).isNull(), F.col("text")))
    events = flatten_incidents(read_texts(untyped), _TYPED)
    return events.select(F.coalesce(_TYPED, message_of_event()).alias("value"))


_TYPED = "_typed"


def _with_typed_message(rows: DataFrame, text: str) -> DataFrame:
    """Adds the message with the types of ``text``; null where that cannot be read as a variant.

    A column for each step, so that none is computed again for each of its uses.
    """
    value = {key: f"_value_{key}" for key in RAW_TO_WIRE}
    parsed = rows.withColumn("_variant", F.try_parse_json(text))
    read = parsed.withColumns(
        {name: F.try_variant_get("_variant", f"$.{key}", "variant") for key, name in value.items()}
    )
    shown = ("r", "f")
    kinds = read.withColumns({f"_kind_{key}": F.schema_of_variant(value[key]) for key in shown})
    label = F.coalesce(
        *[F.when(_counts(F.col(value[key]), F.col(f"_kind_{key}")), F.col(value[key])) for key in shown],
        value["t"],
    )
    named = [F.col(value[key]).alias(wire) for key, wire in RAW_TO_WIRE.items()]
    fields = ["trafficModelId", *named, label.alias("area_hint"), F.col("_variant").alias("_raw")]
    message = F.when(F.col("_variant").isNotNull(), json_message(*fields))
    return kinds.select(*rows.columns, message.alias(_TYPED))


def _counts(value: Column, kind: Column) -> Column:
    """Whether a JSON value of that kind says something: not null, empty, zero or false."""
    text = F.try_variant_get(value, "$", "string")
    return F.coalesce(
        F.when(kind == "STRING", text != "")
        .when(kind == "BOOLEAN", text == "true")
        .when(kind == "VOID", F.lit(False))
        .when(kind.startswith("OBJECT"), text != "{}")
        .when(kind.startswith("ARRAY"), text != "[]")
        .otherwise(text.try_cast("double") != 0),
        F.lit(False),
    )


def message_of_event() -> Column:
    """The thirteen event columns as one JSON object."""
    return json_message(*[F.col(f"`{name}`") for name in WIRE.names])


def incidents_per_snapshot(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """Number of incidents in each document, counted before any is dropped."""
    kept = [name for name in documents.columns if name != payload]
    only_id = StructType([StructField("id", StringType())])
    together = F.from_json(payload, snapshot_of(only_id))["tm"]["poi"]
    texts = F.from_json(payload, snapshot_of(StringType()))["tm"]["poi"]
    size = F.coalesce(F.array_size(together), F.array_size(texts), F.lit(0))
    return documents.select(*kept, size.alias("incidents"))

"""Declared schemas. Every field is nullable: parsing is permissive."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# The fields of the wire format, in order.
INGREDIENT = StructType([
    StructField("item", StringType()),
    StructField("amount_kg", DoubleType()),
])

METADATA = StructType([
    StructField("event_id", StringType()),
    StructField("event_type", StringType()),
    StructField("source", StringType()),
    StructField("generated_at", StringType()),
])

KITCHEN_PAYLOAD = StructType([
    StructField("batch_id", StringType()),
    StructField("station_id", StringType()),
    StructField("recipe_id", StringType()),
    StructField("action", StringType()),
    StructField("weight_kg", DoubleType()),
    StructField("ingredients", ArrayType(INGREDIENT)),
    StructField("temperature_celsius", DoubleType()),
    StructField("event_timestamp", StringType()),
])

DISPATCH_PAYLOAD = StructType([
    StructField("batch_id", StringType()),
    StructField("canteen_id", StringType()),
    StructField("driver_id", StringType()),
    StructField("action", StringType()),
    StructField("truck_temp_celsius", DoubleType()),
    StructField("event_timestamp", StringType()),
])

KITCHEN_ENVELOPE = StructType([
    StructField("metadata", METADATA),
    StructField("payload", KITCHEN_PAYLOAD),
])

DISPATCH_ENVELOPE = StructType([
    StructField("metadata", METADATA),
    StructField("payload", DISPATCH_PAYLOAD),
])

# Presence view of an envelope: one JSON parse yields the key sets of both
# objects (a JSON null value still counts as a present key); a member that is
# not an object comes back null.
ENVELOPE_KEYS = StructType([
    StructField("metadata", MapType(StringType(), StringType())),
    StructField("payload", MapType(StringType(), StringType())),
])

# The envelope as the first member of an object that must be read to its end.
WRAPPED_KEYS = StructType([
    StructField("d", ENVELOPE_KEYS),
    StructField("end", BooleanType()),
])

# A message as read from a topic (Kafka columns, value already text). The
# ingest time is kept zone-free (Kafka times are converted in UTC).
RAW_MESSAGE = StructType([
    StructField("key", StringType()),
    StructField("value", StringType()),
    StructField("topic", StringType()),
    StructField("timestamp", TimestampNTZType()),
])

# Raw archive and dead-letter tables.
RAW_ARCHIVE = StructType([
    StructField("message_key", StringType()),
    StructField("raw_message", StringType()),
    StructField("event_timestamp", TimestampNTZType()),
])

KITCHEN_CURATED = StructType(
    METADATA.fields + KITCHEN_PAYLOAD.fields + [
        StructField("expected_start_weight", DoubleType()),
        StructField("sensor_status", StringType()),
        StructField("temperature_status", StringType()),
        StructField("weight_status", StringType()),
        StructField("event_date", DateType()),
    ]
)

DISPATCH_CURATED = StructType(
    METADATA.fields + DISPATCH_PAYLOAD.fields + [
        StructField("sensor_status", StringType()),
        StructField("temperature_status", StringType()),
        StructField("event_date", DateType()),
    ]
)

# Classified dead letters as stored (partitioned by the payload date).
DLQ_CLASSIFIED = StructType(
    RAW_ARCHIVE.fields + [
        StructField("payload_timestamp", StringType()),
        StructField("event_id", StringType()),
        StructField("batch_id", StringType()),
        StructField("error_reason", StringType()),
        StructField("event_date", DateType()),
    ]
)

# Key -> dates index of the curated tables.
BATCH_DATES = StructType([
    StructField("batch_id", StringType()),
    StructField("event_date", DateType()),
    StructField("kitchen_rows", LongType()),
    StructField("dispatch_rows", LongType()),
])

# Stored graph tables: edges with properties carry the day of their time.
PROCESSED_EDGES = StructType([
    StructField("src", StringType()),
    StructField("dst", StringType()),
    StructField("action", StringType()),
    StructField("time", StringType()),
    StructField("temp_celsius", DoubleType()),
    StructField("weight", DoubleType()),
    StructField("event_id", StringType()),
    StructField("event_day", DateType()),
])
DELIVERS_EDGES = StructType([
    StructField("src", StringType()),
    StructField("dst", StringType()),
    StructField("action", StringType()),
    StructField("time", StringType()),
    StructField("truck_temp_celsius", DoubleType()),
    StructField("event_id", StringType()),
    StructField("event_day", DateType()),
])
PLAIN_EDGES = StructType([StructField("src", StringType()), StructField("dst", StringType())])
NODES = StructType([StructField("id", StringType()), StructField("label", StringType())])

# Router output as stored (partitioned by route).
ROUTED = StructType([
    StructField("key", StringType()),
    StructField("value", StringType()),
    StructField("topic", StringType()),
    StructField("timestamp", TimestampNTZType()),
    StructField("is_valid", BooleanType()),
    StructField("route", StringType()),
])

"""Envelope validation, routing, raw decoding and parsing.

All operators here are per-row projections (no shuffle) and serve batch and
streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from batchtrace import config as C
from batchtrace import schemas


_STRICT = {"allowSingleQuotes": "false"}


def is_valid_envelope(value: Column) -> Column:
    """True iff the text is a JSON object whose ``metadata`` object has
    ``event_id`` and ``event_type`` keys and whose ``payload`` object has
    ``batch_id`` and ``action`` keys. Never null. A key with a JSON null value
    is present.

    ``from_json`` stops after the first value of a text, so the text is parsed
    as a member of an object whose last member must be reached; text that adds
    members of its own is no single element of an array. Together the two tests
    accept exactly one strict JSON document. The parsed text is bound by a
    one-element ``exists``, so the key tests share one parse also where
    Catalyst inlines them into a pushed filter, which has no common
    subexpressions.
    """
    wrapped = F.from_json(F.concat(F.lit('{"d":'), value, F.lit(',"end":true}')), schemas.WRAPPED_KEYS, _STRICT)

    def has_keys(w: Column) -> Column:
        meta, payload = w["d"]["metadata"], w["d"]["payload"]
        return (w["end"] & F.map_contains_key(meta, "event_id") & F.map_contains_key(meta, "event_type")
                & F.map_contains_key(payload, "batch_id") & F.map_contains_key(payload, "action"))

    one_document = F.json_array_length(F.concat(F.lit("["), value, F.lit("]"))) == 1
    return F.coalesce(F.exists(F.array(wrapped), has_keys) & one_document, F.lit(False))


def validate(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """``raw`` plus a boolean ``is_valid``."""
    return raw.withColumn("is_valid", is_valid_envelope(F.col(value_col).cast("string")))


def route_column(is_valid: Column, topic: Column, topics: C.Topics = C.Topics()) -> Column:
    """Route label: invalid → dlq; valid kitchen / dispatch → clean topic;
    a message from any other topic gets no route (it is not subscribed)."""
    known = topic.isin(topics.kitchen, topics.dispatch)
    return (F.when(~known | topic.isNull(), F.lit(None).cast("string"))
            .when(~is_valid, F.lit(C.ROUTE_DLQ))
            .when(topic == topics.kitchen, F.lit(C.ROUTE_CLEAN_KITCHEN))
            .otherwise(F.lit(C.ROUTE_CLEAN_DISPATCH)))


def route(raw: DataFrame, topics: C.Topics = C.Topics(), keep_dropped: bool = False) -> DataFrame:
    """``raw`` plus ``is_valid`` and ``route``.

    Messages from topics other than the two subscribed ones are dropped first,
    by a filter on the raw ``topic`` column (cheap, pushed to the source), so
    every remaining row has a route and no filter on the parsed result is
    needed. ``keep_dropped`` keeps them with a null route instead.
    """
    if not keep_dropped:
        raw = raw.filter(F.col("topic").isin(topics.kitchen, topics.dispatch))
    out = validate(raw)
    return out.withColumn("route", route_column(F.col("is_valid"), F.col("topic"), topics))


def route_topic_column(route_col: Column, topics: C.Topics = C.Topics()) -> Column:
    """Destination topic name of a route label (for a Kafka sink)."""
    return (F.when(route_col == C.ROUTE_CLEAN_KITCHEN, F.lit(topics.clean_kitchen))
            .when(route_col == C.ROUTE_CLEAN_DISPATCH, F.lit(topics.clean_dispatch))
            .when(route_col == C.ROUTE_DLQ, F.lit(topics.dlq)))


def message_key(value: Column) -> Column:
    """Publish key of a source event: its ``metadata.event_id``, or null."""
    return F.get_json_object(value, "$.metadata.event_id")


def with_message_key(events: DataFrame, value_col: str = "value") -> DataFrame:
    """Source events keyed for publishing (S12): key = metadata.event_id, or
    null when the envelope has none."""
    return events.withColumn("key", message_key(F.col(value_col).cast("string")))


def decode_raw(raw: DataFrame, *keep: str) -> DataFrame:
    """Raw archive rows: key and value as text, ingest time kept (plus any
    ``keep`` columns)."""
    return raw.select(
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("raw_message"),
        F.col("timestamp").alias("event_timestamp"),
        *keep,
    )


def parse_envelope(raw: DataFrame, schema: StructType) -> DataFrame:
    """Typed parse of the envelope, flattened to metadata then payload columns.

    Malformed text gives an all-null row (permissive), never an error.
    """
    data = F.from_json(F.col("value").cast("string"), schema).alias("data")
    return raw.select(data).select("data.metadata.*", "data.payload.*")

"""Envelope validation, routing and parsing on hand-made messages."""

from datetime import datetime

from pyspark.sql import functions as F

from batchtrace import config as C
from batchtrace import schemas
from batchtrace.operators.ingest import decode_raw, parse_envelope, route

TS = datetime(2024, 1, 5, 6, 0)
GOOD = '{"metadata": {"event_id": "E1", "event_type": "kitchen_action"}, "payload": {"batch_id": "B1", "action": "COOKING"}}'

CASES = [
    # (value, topic, expected route)
    (GOOD, C.KITCHEN_TOPIC, C.ROUTE_CLEAN_KITCHEN),
    (GOOD, C.DISPATCH_TOPIC, C.ROUTE_CLEAN_DISPATCH),
    # JSON null values are present keys: still valid
    ('{"metadata": {"event_id": null, "event_type": null}, "payload": {"batch_id": null, "action": null}}',
     C.KITCHEN_TOPIC, C.ROUTE_CLEAN_KITCHEN),
    ('{"metadata": {"event_id": "E1", "event_type": "x"}, "payload": {"batch_id": "B1"}}', C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    ('{"metadata": {"event_id": "E1"}, "payload": {"batch_id": "B1", "action": "A"}}', C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    ('{"payload": {"batch_id": "B1", "action": "A"}}', C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    ('{"metadata": {"event_id": "E1", "event_type": "x"}}', C.DISPATCH_TOPIC, C.ROUTE_DLQ),
    # members that are not objects, payload null
    ('{"metadata": "event_id event_type", "payload": {"batch_id": "B1", "action": "A"}}', C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    ('{"metadata": {"event_id": "E1", "event_type": "x"}, "payload": null}', C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    ('{"metadata": {"event_id": "E1", "event_type": "x"}, "payload": [1, 2]}', C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    # not JSON objects at all
    ('"CORRUPT_TEXT"', C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    ("{bad", C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    ("", C.DISPATCH_TOPIC, C.ROUTE_DLQ),
    (None, C.DISPATCH_TOPIC, C.ROUTE_DLQ),
    ("[1, 2]", C.DISPATCH_TOPIC, C.ROUTE_DLQ),
    # exactly one strict document: white space around it is fine, anything else is not
    (" \n" + GOOD + "\t ", C.KITCHEN_TOPIC, C.ROUTE_CLEAN_KITCHEN),
    (GOOD + " junk", C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    (GOOD + GOOD, C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    (GOOD + "," + GOOD, C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    (GOOD + "][" + GOOD, C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    (GOOD + "]][[" + GOOD, C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    (GOOD + ',"end":true}{"d":' + GOOD, C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    (GOOD + ',"x":1', C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    (GOOD + "}", C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    (GOOD.replace('"', "'"), C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    (GOOD.replace("COOKING", "COO\nKING"), C.KITCHEN_TOPIC, C.ROUTE_DLQ),
    (GOOD.replace("COOKING", "COO\x01KING"), C.KITCHEN_TOPIC, C.ROUTE_DLQ),
]


def _raw(spark, rows):
    return spark.createDataFrame([(None, v, t, TS) for v, t in rows], schemas.RAW_MESSAGE)


def test_routes(spark):
    rows = [(v, t) for v, t, _ in CASES]
    got = [r["route"] for r in route(_raw(spark, rows)).collect()]
    assert got == [exp for _, _, exp in CASES]


def test_unknown_topic_dropped(spark):
    raw = _raw(spark, [(GOOD, "other_topic"), ("{bad", "other_topic"), (GOOD, C.KITCHEN_TOPIC)])
    assert route(raw).count() == 1
    kept = route(raw, keep_dropped=True).collect()
    assert [r["route"] for r in kept] == [None, None, C.ROUTE_CLEAN_KITCHEN]


def test_validity_is_never_null(spark):
    rows = [(v, t) for v, t, _ in CASES]
    assert route(_raw(spark, rows)).filter(F.col("is_valid").isNull()).count() == 0


def test_parse_is_permissive(spark):
    raw = _raw(spark, [("{bad", C.KITCHEN_TOPIC), (GOOD, C.KITCHEN_TOPIC)])
    rows = parse_envelope(raw, schemas.KITCHEN_ENVELOPE).collect()
    assert rows[0]["event_id"] is None and rows[0]["batch_id"] is None
    assert rows[1]["event_id"] == "E1" and rows[1]["action"] == "COOKING"
    assert parse_envelope(raw, schemas.KITCHEN_ENVELOPE).columns == (
        schemas.METADATA.fieldNames() + schemas.KITCHEN_PAYLOAD.fieldNames())


def test_decode_raw(spark):
    df = spark.createDataFrame([(b"k1", b'{"a": 1}', "t", TS)],
                               "key binary, value binary, topic string, timestamp timestamp_ntz")
    r = decode_raw(df).collect()[0]
    assert (r["message_key"], r["raw_message"], r["event_timestamp"]) == ("k1", '{"a": 1}', TS)

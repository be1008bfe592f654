"""Dead-letter reasons and period reports on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from batchtrace import config as C
from batchtrace import schemas
from batchtrace.functions.period import Period, require_id, row_limit
from batchtrace.operators import reports as R
from batchtrace.operators.dlq import classify_dlq, dlq_reason_counts, dlq_report, dlq_undated

TS = datetime(2024, 1, 5, 6, 0)


def test_dlq_reasons(spark):
    texts = [
        ('"CORRUPT_TEXT"', C.DLQ_INVALID_JSON),
        ("", C.DLQ_INVALID_JSON),
        ("{bad", C.DLQ_MISSING_METADATA),
        ('{"payload": {"batch_id": "B", "event_timestamp": "2024-01-05T06:00"}}', C.DLQ_MISSING_METADATA),
        ('{"metadata": {"event_type": "x"}, "payload": {}}', C.DLQ_MISSING_EVENT_ID),
        ('{"metadata": {"event_id": null, "event_type": "x"}, "payload": {}}', C.DLQ_MISSING_EVENT_ID),
        ('{"metadata": {"event_id": "E"}, "payload": {}}', C.DLQ_MISSING_EVENT_TYPE),
        ('{"metadata": {"event_id": "E", "event_type": "x"}}', C.DLQ_MISSING_PAYLOAD),
        ('{"metadata": {"event_id": "E", "event_type": "x"}, "payload": {"action": "A"}}', C.DLQ_MISSING_BATCH_ID),
        ('{"metadata": {"event_id": "E", "event_type": "x"}, "payload": {"batch_id": "B"}}', C.DLQ_MISSING_ACTION),
        ('{"metadata": {"event_id": "E", "event_type": "x"}, "payload": {"batch_id": "B", "action": "A"}}', C.DLQ_OTHERS),
    ]
    df = spark.createDataFrame([("k", t, TS) for t, _ in texts], schemas.RAW_ARCHIVE)
    got = [r["error_reason"] for r in classify_dlq(df).collect()]
    assert got == [reason for _, reason in texts]


def test_dlq_dates_and_reports(spark):
    texts = [
        '{"payload": {"batch_id": "B1", "event_timestamp": "2024-01-31T23:59"}}',
        '{"payload": {"batch_id": "B2", "event_timestamp": "2024-02-01T00:00"}}',
        '{"payload": {"batch_id": "B3", "event_timestamp": "garbage"}}',
        '"CORRUPT_TEXT"',
    ]
    q = classify_dlq(spark.createDataFrame([("k", t, TS) for t in texts], schemas.RAW_ARCHIVE))
    assert [r["batch_id"] for r in dlq_report(q, Period.month("2024-01")).collect()] == ["B1"]
    assert [r["batch_id"] for r in dlq_report(q, "2024-02-01").collect()] == ["B2"]
    assert sorted(str(r["batch_id"]) for r in dlq_undated(q).collect()) == ["B3", "None"]
    assert dlq_report(q, "2024-01-31").columns == ["payload_timestamp", "event_id", "batch_id", "error_reason"]
    counts = {r["error_reason"]: r["n_messages"] for r in dlq_reason_counts(q).collect()}
    assert counts == {C.DLQ_MISSING_METADATA: 3, C.DLQ_INVALID_JSON: 1}


def test_period_parsing():
    assert Period.parse("2024-01-05").kind == "day"
    m = Period.parse("2024-12")
    assert (m.start, m.end) == (date(2024, 12, 1), date(2025, 1, 1))
    assert Period.month(2024, 2).end == date(2024, 3, 1)
    for bad in ("2024-1-5", "2024-02-30", "05-01-2024", "2024-13"):
        with pytest.raises(ValueError):
            Period.parse(bad)
    with pytest.raises(ValueError):
        require_id("  ")
    assert row_limit("x") == 5 and row_limit("12") == 12 and row_limit(0) == 5


def _k(spark, rows):
    cols = ["event_id", "batch_id", "station_id", "recipe_id", "action", "event_timestamp",
            "temperature_status", "weight_status", "sensor_status", "ingredients", "event_date"]
    schema = ("event_id string, batch_id string, station_id string, recipe_id string, action string, "
              "event_timestamp string, temperature_status string, weight_status string, sensor_status string, "
              "ingredients array<struct<item:string,amount_kg:double>>, event_date date")
    return spark.createDataFrame([dict(zip(cols, r)) for r in rows], schema)


ING_A = [Row(item="x", amount_kg=1.25), Row(item="y", amount_kg=2.0)]
ING_B = [Row(item="x", amount_kg=9.0)]


def test_month_boundaries_and_null_keys(spark):
    d31, d1 = date(2024, 1, 31), date(2024, 2, 1)
    k = _k(spark, [
        ("E1", "B1", "s1", "r1", "COOKING", "2024-01-31T23:50", "OK", "UNKNOWN", "SENSOR_FAILURE", ING_A, d31),
        ("E2", "B1", "s1", "r1", "PACKING", "2024-02-01T00:10", "OK", "OK", "OK", ING_A, d1),
        ("E3", None, None, "r2", "PREPARING", "2024-01-10T08:00", "OK", "OK", "OK", ING_B, date(2024, 1, 10)),
        ("E4", "B9", "s2", "r1", "COOKING", "2024-01-02T08:00", "LOW_HEAT_WARNING", "OK", "OK", ING_A, date(2024, 1, 2)),
    ])
    st = {r["station_id"]: tuple(r)[1:] for r in R.station_report(k, "2024-01").collect()}
    assert st == {"s1": (1, 0, 1, 1), None: (1, 0, 0, 0), "s2": (1, 1, 0, 0)}
    assert {r["recipe_id"]: r["total_times_cooked"] for r in R.recipe_report(k, "2024-01").collect()} == {"r1": 2, "r2": 0}
    feb = R.station_report(k, "2024-02").collect()
    assert [(r["station_id"], r["total_times_active"]) for r in feb] == [("s1", 1)]
    d = spark.createDataFrame([], schemas.DISPATCH_CURATED)
    # null batch id counts once; a batch spanning midnight counts in both months
    assert R.batch_count(k, d, "2024-01").collect()[0]["total_batches"] == 3
    assert R.batch_count(k, d, "2024-02").collect()[0]["total_batches"] == 1


def test_ingredient_usage_one_row_per_batch(spark):
    k = _k(spark, [
        ("E2", "B1", "s1", "r1", "COOKING", "2024-01-05T07:00", "OK", "OK", "OK", ING_B, date(2024, 1, 5)),
        ("E1", "B1", "s1", "r1", "PREPARING", "2024-01-05T06:00", "OK", "OK", "OK", ING_A, date(2024, 1, 5)),
        ("E3", "B2", "s1", "r1", "PREPARING", "2024-01-05T06:00", "OK", "OK", "OK", ING_A, date(2024, 1, 5)),
    ])
    got = [tuple(r) for r in R.ingredient_usage(k, "2024-01-05").collect()]
    assert got == [("r1", "y", 4.0), ("r1", "x", 2.5)]


def test_listing_order_and_limit(spark):
    k = _k(spark, [
        ("E2", "B1", "s1", "r1", "COOKING", "2024-01-05T07:00", "OK", "OK", "OK", ING_B, date(2024, 1, 5)),
        ("E1", "B1", "s1", "r1", "PREPARING", "2024-01-05T06:00", "OK", "OK", "OK", ING_A, date(2024, 1, 5)),
    ]).withColumn("temperature_celsius", F.lit(1.0)).withColumn("weight_kg", F.lit(1.0))
    rows = R.kitchen_listing(k, "2024-01-05").collect()
    assert [r["action"] for r in rows] == ["PREPARING", "COOKING"]
    assert len(R.kitchen_listing(k, "2024-01-05", limit=1).collect()) == 1
    assert list(rows[0].asDict()) == list(R.KITCHEN_LISTING_COLUMNS)

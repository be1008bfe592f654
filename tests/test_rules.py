"""Business-rule flags at their boundaries."""

from pyspark.sql import Row

from batchtrace import config as C
from batchtrace import schemas
from batchtrace.operators.rules import dispatch_rules, event_date, kitchen_rules
from pyspark.sql import functions as F


def _kitchen(spark, rows):
    return spark.createDataFrame(rows, schemas.KITCHEN_PAYLOAD)


def ing(*amounts):
    return [Row(item=f"i{n}", amount_kg=a) for n, a in enumerate(amounts)]


def test_kitchen_flags(spark):
    rows = [
        # batch, station, recipe, action, weight, ingredients, temp, ts
        ("B", "s", "r", "COOKING", 8.0, ing(5.0, 5.0), 75.0, "2024-01-05T06:00"),    # exactly min temp: OK; drop exactly 2.0: flagged
        ("B", "s", "r", "COOKING", 8.01, ing(5.0, 5.0), 74.9, "2024-01-05T06:00"),   # low heat; drop 1.99: OK
        ("B", "s", "r", "PACKING", None, ing(5.0), 50.0, "2024-01-05T06:00"),        # null weight: UNKNOWN, sensor failure
        ("B", "s", "r", "COOKING", 5.0, ing(5.0), None, "2024-01-05T06:00"),         # null temp: sensor failure, temp OK
        ("B", "s", "r", "LOADING", 1.0, ing(5.0), 10.0, "2024-01-05T06:00"),         # not a kitchen action: no drop flag
        ("B", "s", "r", "PREPARING", 1.0, None, 10.0, "2024-01-05T06:00"),           # null ingredients: expected null, OK
        ("B", "s", "r", "PREPARING", 1.0, [], 10.0, "2024-01-05T06:00"),             # empty: expected 0.0
        ("B", "s", "r", "PREPARING", 1.0, ing(5.0, None), 10.0, "2024-01-05T06:00"), # a null amount: expected null
    ]
    out = kitchen_rules(_kitchen(spark, rows)).collect()
    got = [(r["expected_start_weight"], r["sensor_status"], r["temperature_status"], r["weight_status"]) for r in out]
    assert got == [
        (10.0, C.OK, C.OK, C.SUSPICIOUS_DROP),
        (10.0, C.OK, C.LOW_HEAT_WARNING, C.OK),
        (5.0, C.SENSOR_FAILURE, C.OK, C.UNKNOWN),
        (5.0, C.SENSOR_FAILURE, C.OK, C.OK),
        (5.0, C.OK, C.OK, C.OK),
        (None, C.OK, C.OK, C.OK),
        (0.0, C.OK, C.OK, C.OK),
        (None, C.OK, C.OK, C.OK),
    ]


def test_expected_weight_rounds_half_up(spark):
    out = kitchen_rules(_kitchen(spark, [("B", "s", "r", "PREPARING", 1.0, ing(1.0, 0.005), 10.0, "t")])).collect()
    assert out[0]["expected_start_weight"] == 1.01


def test_dispatch_flags(spark):
    rows = [("B", "c", "d", "DELIVERY", t, "2024-01-05T06:00") for t in (5.0, 5.01, None, -3.0)]
    out = dispatch_rules(spark.createDataFrame(rows, schemas.DISPATCH_PAYLOAD)).collect()
    assert [(r["sensor_status"], r["temperature_status"]) for r in out] == [
        (C.OK, C.OK), (C.OK, C.WARM_TRUCK_WARNING), (C.SENSOR_FAILURE, C.OK), (C.OK, C.OK)]


def test_thresholds_are_parameters(spark):
    t = C.Thresholds(max_truck_temp=8.0, min_cook_temp=80.0, min_weight_drop=0.5)
    k = kitchen_rules(_kitchen(spark, [("B", "s", "r", "COOKING", 9.5, ing(10.0), 79.0, "t")]), t).collect()[0]
    assert (k["temperature_status"], k["weight_status"]) == (C.LOW_HEAT_WARNING, C.SUSPICIOUS_DROP)
    d = dispatch_rules(spark.createDataFrame([("B", "c", "d", "DELIVERY", 6.0, "t")], schemas.DISPATCH_PAYLOAD), t)
    assert d.collect()[0]["temperature_status"] == C.OK
    assert C.Thresholds.from_mapping({"max_truck_temp": 1, "other": 2}).max_truck_temp == 1.0


def test_event_date(spark):
    df = spark.createDataFrame([("2024-01-31T23:59",), ("2024-02-01T00:00",), ("nope",), (None,), ("2024-13-01",)], "t string")
    got = [r[0] for r in df.select(event_date(F.col("t"))).collect()]
    assert [str(g) if g else None for g in got] == ["2024-01-31", "2024-02-01", None, None, None]

"""Journeys, delivery spans, league table, ranking and graph queries."""

import re
from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from batchtrace import schemas
from batchtrace.operators import graph as G
from batchtrace.operators import journey as J


def _d(spark, rows):
    # (event_id, batch, canteen, driver, action, ts)
    data = [dict(event_id=e, batch_id=b, canteen_id=c, driver_id=dr, action=a, event_timestamp=t,
                 truck_temp_celsius=3.0, event_date=date(2024, 1, 5)) for e, b, c, dr, a, t in rows]
    return spark.createDataFrame(data, schemas.DISPATCH_CURATED)


def _k(spark, rows):
    # (event_id, batch, station, recipe, action, ts, items)
    data = [dict(event_id=e, batch_id=b, station_id=s, recipe_id=r, action=a, event_timestamp=t,
                 weight_kg=1.0, temperature_celsius=80.0,
                 ingredients=[{"item": i, "amount_kg": 1.0} for i in items] if items is not None else None,
                 event_date=date(2024, 1, 5)) for e, b, s, r, a, t, items in rows]
    return spark.createDataFrame(data, schemas.KITCHEN_CURATED)


def test_delivery_spans_minute_boundaries(spark):
    d = _d(spark, [
        ("D1", "B1", "c1", "drv1", "LOADING", "2024-01-05T06:00:50"),
        ("D2", "B1", "c1", "drv1", "DELIVERED", "2024-01-05T06:01:10"),   # crosses one minute boundary
        ("D3", "B2", "c1", "drv1", "LOADING", "2024-01-05T07:00"),         # never delivered: dropped
        ("D4", "B3", "c2", "drv2", "LOADING", "2024-01-05T08:00"),
        ("D5", "B3", "c2", "drv2", "DELIVERY", "2024-01-05T08:30"),        # ignored action
        ("D6", "B3", "c2", "drv2", "DELIVERED", "2024-01-05T09:15"),
        ("D7", "B4", "c2", "drv2", "LOADING", "2024-01-05T10:00"),
        ("D8", "B4", "c2", "drv2", "DELIVERED", "2024-01-05T10:30"),
        ("D9", "B5", "c2", "drv3", "LOADING", "nope"),
        ("D10", "B5", "c2", "drv3", "DELIVERED", "2024-01-05T10:30"),      # unparsable start: dropped
    ])
    spans = {(r["batch_id"], r["driver_id"]): r["delivery_time_mins"] for r in J.delivery_spans(d).collect()}
    assert spans == {("B1", "drv1"): 1, ("B3", "drv2"): 75, ("B4", "drv2"): 30}
    board = [tuple(r) for r in J.driver_leaderboard(d).collect()]
    assert board == [(1, "drv1", 1, 1, 1.0, 1), (2, "drv2", 30, 75, 52.5, 2)]


def test_journey_order_and_exists(spark):
    k = _k(spark, [("K2", "B1", "cook_01", "r", "COOKING", "2024-01-05T07:00", ["a"]),
                   ("K1", "B1", None, "r", "PREPARING", "2024-01-05T06:00", ["a"]),
                   ("K9", "B2", "prep_01", "r", "PREPARING", "2024-01-05T06:00", ["a"])])
    d = _d(spark, [("D1", "B1", "c", "drv1", "LOADING", "2024-01-05T07:00")])
    j = J.batch_journey(k, d, "B1").collect()
    assert [(r["source"], r["location"]) for r in j] == [
        ("Kitchen", "Station None"), ("Kitchen", "Station cook_01"), ("Dispatch", "Driver drv1")]
    e = J.batch_exists(k, d, "B1").collect()[0]
    assert (e["in_kitchen"], e["in_dispatch"], e["found"]) == (True, True, True)
    assert tuple(J.batch_exists(k, d, "nope").first())[1:] == (False, False, False)
    assert tuple(J.batch_exists(k, d.limit(0), "B1").first())[1:] == (True, False, True)


def _graph_input(spark):
    k = _k(spark, [
        ("K1", "B1", "prep_01", "r1", "PREPARING", "2024-01-05T06:00", ["x", "y"]),
        ("K2", "B1", "cook_01", "r1", "COOKING", "2024-01-05T06:20", ["x", "y"]),
        ("K3", "B1", "pack_01", "r1", "PACKING", "2024-01-05T06:40", ["x", "y"]),
        ("K4", "B1", "cook_01", "r1", "COOKING", "2024-01-05T06:30", ["x", "y"]),  # second visit: latest wins
        ("K5", "B2", "cook_01", "r2", "COOKING", "2024-01-05T09:00", ["z"]),
        ("K6", "B3", "cook_01", "r1", "COOKING", "2024-01-06T09:00", None),
        ("K7", None, "cook_01", "r1", "COOKING", "2024-01-05T09:00", ["x"]),      # null batch: no edge
    ])
    d = _d(spark, [("D1", "B1", "cant_01", "drv_01", "LOADING", "2024-01-05T07:00"),
                   ("D2", "B1", "cant_01", "drv_01", "DELIVERED", "2024-01-05T08:00"),
                   ("D3", "B2", "cant_02", "drv_02", "LOADING", "2024-01-05T10:00")])
    return k, d


def test_edges_last_write_wins_and_upsert(spark):
    k, d = _graph_input(spark)
    e = G.build_edges(k, d)
    proc = {(r["src"], r["dst"]): r["time"] for r in e.processed.collect()}
    assert proc[("cook_01", "B1")] == "2024-01-05T06:30" and len(proc) == 5
    assert {(r["src"], r["dst"]) for r in e.requires.collect()} == {("r1", "x"), ("r1", "y"), ("r2", "z")}
    assert {r["action"] for r in e.delivers.collect()} == {"DELIVERED", "LOADING"}
    again = G.upsert_edges(e, e)
    for name, df in again.as_dict().items():
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, getattr(e, name).collect())), name
    nodes = {(r["label"], r["id"]) for r in G.build_nodes(k, d).collect()}
    assert ("Ingredient", "z") in nodes and ("Batch", None) not in nodes and len(nodes) == 15


def test_rows_of_one_version_have_one_winner_and_each_property_is_shuffled_once(spark):
    rows = [
        ("K1", "B1", "cook_01", "r1", "COOKING", "2024-01-05T06:00", None),
        ("K1", "B1", "cook_01", "r1", "PACKING", "2024-01-05T06:00", None),  # the same version again
        ("K2", "B1", "cook_01", "r1", "PREPARING", None, None),              # undated: before any time
        ("K3", "B2", "cook_01", "r1", "COOKING", None, None),
        ("K4", "B2", "cook_01", "r1", None, None, None),
    ]
    none = _d(spark, [])

    def edges(some):
        return G.build_edges(_k(spark, some).coalesce(1), none)

    def found(e):
        return sorted((r["src"], r["dst"], r["event_id"], r["action"], r["time"]) for r in e.processed.collect())

    expected = [("cook_01", "B1", "K1", "PACKING", "2024-01-05T06:00"), ("cook_01", "B2", "K4", None, None)]
    for some in (rows, rows[::-1]):
        assert found(edges(some)) == expected
        first, rest = edges(some[:2]), edges(some[2:])
        assert found(G.upsert_edges(G.upsert_edges(first, rest), first)) == expected
    processed = G.build_edges(_k(spark, rows), none).processed
    assert processed.columns == ["src", "dst", *G.PROCESSED_PROPS, "event_day"]
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = processed._jdf.queryExecution().explainString(mode)
    assert re.findall(r"Exchange\nInput \[(\d+)\]", plan) == ["3"]  # src, dst and one struct


def test_recall_and_risk(spark):
    k, d = _graph_input(spark)
    e = G.build_edges(k, d)
    recall = [tuple(r) for r in G.ingredient_recall(e, "x", "2024-01-05").collect()]
    assert recall == [("x", "r1", "B1", "cant_01")]
    risk = [tuple(r) for r in G.contamination_risk(e, "cook_01", "2024-01-05").collect()]
    assert risk == [("cook_01", "B1", "pack_01", 1, "drv_01", "cant_01"),
                    ("cook_01", "B2", "None", 0, "drv_02", "cant_02")]


def test_a_day_is_needed_and_the_answer_does_not_depend_on_storage(spark):
    from batchtrace.plans.warehouse import Warehouse, merge_graph
    from batchtrace.session import scratch_path
    k, d = _graph_input(spark)
    memory = G.build_edges(k, d)
    with pytest.raises(ValueError):
        G.ingredient_recall(memory, "x", "2024-01")
    wh = merge_graph(spark, Warehouse(scratch_path(spark, "g")), k, d)
    stored = wh.graph_edges(spark)
    for a, b in zip(memory.as_dict().values(), stored.as_dict().values(), strict=True):
        assert sorted(a.columns) == sorted(b.columns)
        assert sorted(map(repr, a.select(*sorted(a.columns)).collect())) == sorted(map(repr, b.select(*sorted(b.columns)).collect()))
    for q in (lambda e: G.ingredient_recall(e, "x", "2024-01-05"), lambda e: G.contamination_risk(e, "cook_01", "2024-01-05")):
        assert [tuple(r) for r in q(memory).collect()] == [tuple(r) for r in q(stored).collect()]
    plan = G.contamination_risk(stored, "cook_01", "2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert ">= 2024-01-05" in plan  # the later events' scan prunes as well


def test_merge_into_the_stored_graph_is_idempotent(spark):
    from batchtrace.plans.warehouse import Warehouse, merge_graph
    from batchtrace.session import scratch_path
    k, d = _graph_input(spark)
    wh = Warehouse(scratch_path(spark, "g"))
    early = F.col("event_id") < "K4"
    for part in (k.filter(early), k.filter(~early), k):
        merge_graph(spark, wh, part, d)
    whole, got = G.build_edges(k, d).as_dict(), wh.graph_edges(spark).as_dict()
    for rel, df in whole.items():
        cols = sorted(df.columns)
        assert sorted(map(repr, df.select(*cols).collect())) == sorted(map(repr, got[rel].select(*cols).collect()))
    nodes = G.build_nodes(k, d)
    assert sorted(map(tuple, wh.graph_nodes(spark).collect())) == sorted(map(tuple, nodes.select("label", "id").collect()))


def test_offsets_in_times_are_honoured(spark):
    rows = [("B1", "d1", "LOADING", "2024-01-05T06:00+02:00"), ("B1", "d1", "DELIVERED", "2024-01-05T06:30+00:00"),
            ("B2", "d1", "LOADING", "2024-01-05T06:00"), ("B2", "d1", "DELIVERED", "2024-01-05T06:30")]
    d = spark.createDataFrame(rows, "batch_id string, driver_id string, action string, event_timestamp string")
    assert {r.batch_id: r.delivery_time_mins for r in J.delivery_spans(d).collect()} == {"B1": 150, "B2": 30}

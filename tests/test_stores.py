"""Versions with history, tables of parts, the stored graph, indexes, partials and loads."""

import time
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from batchtrace import schemas
from batchtrace.functions.period import Period
from batchtrace.operators import graph as G
from batchtrace.operators import journey as J
from batchtrace.operators import reports as R
from batchtrace.plans import rollups as P
from batchtrace.plans.graph_store import GraphStore
from batchtrace.plans.warehouse import Warehouse, merge_graph
from batchtrace.session import at_once, scratch_path
from batchtrace.sinks import catalog
from batchtrace.sinks.parts import PartStore, PartTable
from batchtrace.sinks.versions import ConcurrentWrite, VersionedFolder
from batchtrace.sources.topics import RoutedFiles
from batchtrace.streaming import loads as L
from batchtrace.streaming.pipeline import run_until_idle
from catalog.stores import graph_warehouse, warehouse_for

NOW = {"availableNow": True}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    assert sorted(map(repr, a.select(*cols).collect())) == sorted(map(repr, b.select(*cols).collect()))


# --- versions -------------------------------------------------------------------

def _texts(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def _write(spark, *rows):
    return lambda folder: spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(folder)


def test_versions_are_kept_rolled_back_and_cleaned(spark):
    folder = VersionedFolder(spark, scratch_path(spark, "versions"))
    assert folder.current() is None and folder.clean() == []
    with pytest.raises(ValueError):
        folder.roll_back()
    paths = [folder.replace(_write(spark, f"{i}")) for i in range(4)]
    assert folder.current() == paths[3] and len(folder.history()) == 4
    assert folder.roll_back() == paths[2] == folder.current() and _texts(spark, folder.current()) == ["2"]
    assert folder.clean(keep=1) == []  # all are young
    reader = spark.read.text(folder.current())
    folder.files.write("v-leftover/x", "of a failed writer")
    time.sleep(0.05)
    gone = folder.clean(keep=2, younger_than=0.01)
    assert len(gone) == 3 and "v-leftover" in gone
    assert [r.value for r in reader.collect()] == ["2"]  # a reader of the current version goes on
    assert folder.roll_back(paths[3].rsplit("/", 1)[-1]) == paths[3]  # the other kept one
    with pytest.raises(ValueError):
        folder.roll_back(paths[0].rsplit("/", 1)[-1])


def test_a_version_switched_meanwhile_is_not_lost(spark):
    folder = VersionedFolder(spark, scratch_path(spark, "versions"))

    def slow(path):
        folder.replace(_write(spark, "other"))
        _write(spark, "mine")(path)

    with pytest.raises(ConcurrentWrite):
        folder.replace(slow)
    assert _texts(spark, folder.current()) == ["other"]


def test_at_once_raises_the_first_failure():
    assert at_once([lambda: 1, lambda: 2]) == [1, 2]
    with pytest.raises(ZeroDivisionError):
        at_once([lambda: 1, lambda: 1 // 0])


# --- tables of parts ------------------------------------------------------------

def _part_store(spark, buckets=3):
    plain = StructType([StructField("k", StringType()), StructField("v", StringType())])
    return PartStore(spark, scratch_path(spark, "parts"), (PartTable("a", plain, "p", "k"), PartTable("b", plain, "p")), buckets)


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, p string")


def test_only_touched_parts_are_replaced_and_all_at_once(spark):
    store = _part_store(spark)
    with pytest.raises(FileNotFoundError):
        store.read("a")
    first = [(f"k{i}", "old", f"p{i % 3}") for i in range(30)]
    store.replace({"a": _rows(spark, first), "b": _rows(spark, first)})
    before, held = store.parts("a"), store.read("a")
    store.replace({"a": _rows(spark, [("k1", "new", "p1"), ("it's", "new", "p9")])})
    after = store.parts("a")
    assert {p for p in after if after[p] != before.get(p)} == {"p1", "p9"} and store.parts("b").keys() == {"p0", "p1", "p2"}
    assert sorted(map(tuple, store.read("a").collect())) == sorted([r for r in first if r[2] != "p1"] + [("k1", "new", "p1"), ("it's", "new", "p9")])
    assert held.count() == 30  # a reader of the version before
    with pytest.raises(Exception, match="broken"):
        store.replace({"b": _rows(spark, first), "a": _rows(spark, first).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))})
    assert store.parts("a") == after and store.read("b").count() == 30
    store.replace({"a": _rows(spark, [("k", "whole", "p0")])}, whole=True)
    assert store.read("a").count() == 1 and store.parts("b") == {} and store.read("b").count() == 0


def test_cleaning_keeps_parts_in_use(spark):
    store = _part_store(spark)
    store.replace({"a": _rows(spark, [("k1", "1", "p1"), ("k2", "1", "p2")])})
    store.replace({"a": _rows(spark, [("k1", "2", "p1")])})
    store.replace({"a": _rows(spark, [("k1", "3", "p1")])})
    time.sleep(0.05)
    gone = store.clean(keep=1, younger_than=0.01)
    assert len(gone) == 2 and any(g.endswith("p=p1") for g in gone)  # the second version, and p1 of the first
    assert sorted(map(tuple, store.read("a").collect())) == [("k1", "3", "p1"), ("k2", "1", "p2")]
    assert store.clean(keep=1, younger_than=0.01) == []


def test_part_tables_prune_and_join_without_a_shuffle(spark):
    store = _part_store(spark)
    store.replace({"a": _rows(spark, [(f"k{i}", "x", f"p{i % 4}") for i in range(200)])})
    a = store.read("a")
    assert "PartitionFilters: [isnotnull(p" in _plan(a.filter("p = 'p2'"))
    assert {f.split("p=")[1].split("/")[0] for f in a.filter("p = 'p2'").inputFiles()} == {"p2"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(a.join(a.filter("p = 'p2'").select("k"), "k", "left_semi"))
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- the catalog ----------------------------------------------------------------

def test_stored_tables_are_declared_and_read_without_listing(spark, sf_small):
    wh = warehouse_for(spark, sf_small)
    k = wh.curated(spark).kitchen
    name = catalog.table_name(wh.kitchen, "kitchen")
    assert spark.sql(f"SELECT count(*) FROM `{name}`").first()[0] == k.count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing-test", "reads")
    wh.curated(spark), wh.rollups(spark), wh.batch_index(spark)
    assert not tracker.getJobIdsForGroup("listing-test")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert wh.refresh(spark).curated(spark).kitchen.count() == k.count()
    undated = wh.curated(spark).dlq.filter("event_date IS NULL")
    assert undated.count() == 16 and "PartitionFilters: [isnull(event_date" in _plan(undated)


# --- key -> dates index ---------------------------------------------------------

def test_a_journey_opens_only_the_dates_of_its_batch(spark, sf_small):
    wh = warehouse_for(spark, sf_small)
    c, index = wh.curated(spark), wh.batch_index(spark)
    counts = c.kitchen.filter("batch_id IS NOT NULL").groupBy("batch_id").count().orderBy("count", "batch_id")
    for batch in [counts.first()[0], counts.orderBy(F.desc("count")).first()[0], "BATCH-0", "it's"]:
        _same(J.batch_journey(c.kitchen, c.dispatch, batch), J.batch_journey(c.kitchen, c.dispatch, batch, index))
        _same(J.batch_exists(c.kitchen, c.dispatch, batch), J.indexed_batch_exists(index, batch))
    batch = counts.first()[0]
    k, _ = J.narrowed(c.kitchen, c.dispatch, batch, index)
    held = {r[0] for r in c.kitchen.filter(F.col("batch_id") == batch).select("event_date").distinct().collect()}
    assert {f.split("event_date=")[1].split("/")[0] for f in k.inputFiles()} == {str(d) for d in held}
    assert "event_date" in _plan(k).split("PartitionFilters: [")[1].split("]")[0]
    assert J.narrowed(c.kitchen, c.dispatch, "BATCH-0", index)[0].count() == 0


def test_the_index_holds_undated_rows(spark):
    k = spark.createDataFrame([("B1", date(2024, 1, 5)), ("B1", None), (None, date(2024, 1, 5))], "batch_id string, event_date date")
    d = spark.createDataFrame([("B1", None), ("B2", date(2024, 1, 6))], "batch_id string, event_date date")
    rows = {(r.batch_id, r.event_date): (r.kitchen_rows, r.dispatch_rows) for r in J.batch_dates(k, d).collect()}
    assert rows == {("B1", date(2024, 1, 5)): (1, 0), ("B1", None): (1, 1), ("B2", date(2024, 1, 6)): (0, 1)}
    k2, d2 = J.narrowed(k, d, "B1", J.batch_dates(k, d))
    assert k2.filter("batch_id = 'B1'").count() == 2 and d2.count() == 1


# --- partials -------------------------------------------------------------------

def test_reports_from_partials_equal_reports_from_events(spark, sf_small):
    wh = warehouse_for(spark, sf_small)
    c, p = wh.curated(spark), wh.rollups(spark)
    for period in ("2024-01-05", "2024-01", "2023-12", "2020-01"):
        for of_events, of_days in ((R.station_report(c.kitchen, period), P.station_report(p, period)),
                                   (R.recipe_report(c.kitchen, period), P.recipe_report(p, period)),
                                   (R.driver_report(c.dispatch, period), P.driver_report(p, period)),
                                   (R.canteen_report(c.dispatch, period), P.canteen_report(p, period)),
                                   (R.ingredient_usage(c.kitchen, period), P.ingredient_usage(p, period)),
                                   (R.batch_count(c.kitchen, c.dispatch, period), P.batch_count(p, period)),
                                   (R.row_counts(c.kitchen, c.dispatch, c.dlq, period), P.row_counts(p, period))):
            assert of_events.dtypes == of_days.dtypes and of_events.collect() == of_days.collect()
    assert [r.station_id for r in P.station_report(p, "2024-01", 3).collect()] == [r.station_id for r in R.station_report(c.kitchen, "2024-01", 3).collect()]
    assert "rollup" in _plan(P.station_report(p, "2024-01")) and "batch_id" not in _plan(P.station_report(p, "2024-01"))


# --- the stored graph -----------------------------------------------------------

def _graph_rows(spark, days, batches_a_day=6):
    k, d = [], []
    for day in days:
        for b in range(batches_a_day):
            at = f"2024-01-{day:02d}T0{b}"
            for i, (station, action) in enumerate((("prep_01", "PREPARING"), ("cook_01", "COOKING"), ("pack_01", "PACKING"))):
                k.append(dict(event_id=f"K{day:02d}{b}{i}", batch_id=f"B{day:02d}-{b}", station_id=station, recipe_id=f"r{b % 2}", action=action,
                              event_timestamp=f"{at}:{i}0", ingredients=[{"item": f"item{b % 2}", "amount_kg": 1.0}], event_date=date(2024, 1, day)))
            d.append(dict(event_id=f"D{day:02d}{b}", batch_id=f"B{day:02d}-{b}", canteen_id=f"c{b % 3}", driver_id=f"d{day % 2}", action="DELIVERED",
                          event_timestamp=f"{at}:50", event_date=date(2024, 1, day)))
    return spark.createDataFrame(k, schemas.KITCHEN_CURATED), spark.createDataFrame(d, schemas.DISPATCH_CURATED)


def test_merging_a_day_leaves_the_files_of_other_days(spark):
    store = GraphStore(spark, scratch_path(spark, "g"), buckets=2)
    store.merge(*_graph_rows(spark, range(1, 6)))
    before = {t: dict(store.parts.parts(t)) for t in store.parts.tables}
    assert before["processed"].keys() == {f"2024-01-0{i}" for i in range(1, 6)}
    k, d = _graph_rows(spark, [6])
    late = k.limit(1).withColumns({"batch_id": F.lit("B03-0"), "event_id": F.lit("K99"), "event_timestamp": F.lit("2024-01-06T09:00")})
    store.merge(k.unionByName(late), d)  # the sixth, and a late event of a batch of the third
    after = {t: dict(store.parts.parts(t)) for t in store.parts.tables}
    changed = {t: {p for p in after[t] if after[t][p] != before[t].get(p)} for t in after}
    assert changed == {"processed": {"2024-01-03", "2024-01-06"}, "uses_recipe": {"2024-01-03", "2024-01-06"},
                       "delivers": {"2024-01-06"}, "destined_for": {"2024-01-06"}, "batches": {"2024-01-06"},
                       "requires": set(), "days": {"all"}, "nodes": set()}
    every_k, every_d = _graph_rows(spark, range(1, 7))
    whole = G.build_edges(every_k.unionByName(late), every_d)
    for name, df in whole.as_dict().items():
        _same(df, getattr(store.edges(), name))
    _same(G.build_nodes(every_k, every_d).select("label", "id"), store.nodes())
    # queries read the homes of their day only, also for the batch of the third
    assert store.homes_of(Period.day("2024-01-06")) == ["2024-01-03", "2024-01-06"]
    for day in ("2024-01-06", "2024-01-03", "2024-02-01"):
        _same(G.ingredient_recall(whole, "item0", day), G.ingredient_recall(store.edges(), "item0", day))
        _same(G.contamination_risk(whole, "cook_01", day), G.contamination_risk(store.edges(), "cook_01", day))


def test_path_queries_scan_pruned_parts_without_shuffling_edges(spark, sf_small):
    store = graph_warehouse(spark, sf_small).graph_store(spark)
    edges, day = store.edges(), Period.day("2024-01-05")
    homes = set(store.homes_of(day))
    assert homes < set(store.parts.parts("delivers"))
    for rel in ("processed", "uses_recipe", "delivers", "destined_for"):
        files = getattr(edges.of_day(day), rel).inputFiles()
        assert {f.split("home=")[1].split("/")[0] for f in files} <= homes
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        risk = _plan(G.contamination_risk(edges, "cook_01", day))
        assert risk.count("SortMergeJoin") == 6 and "Exchange hashpartitioning" not in risk
        recall = _plan(G.ingredient_recall(edges, "item_9", day)).splitlines()
        for i, line in enumerate(recall):
            if "_uses_recipe[" in line or "_destined_for[" in line:  # the next exchange above is beyond the semi-join
                above = [x for x in reversed(recall[:i]) if "Exchange" in x or "LeftSemi" in x]
                assert "Bucketed: true" in line and "LeftSemi" in above[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_undated_batches_and_wider_homes(spark):
    k, d = _graph_rows(spark, [1, 9])
    k = k.withColumn("event_date", F.when(F.col("batch_id") != "B09-1", F.col("event_date")))
    k = k.withColumn("event_timestamp", F.when(F.col("batch_id") != "B09-1", F.col("event_timestamp")).otherwise("soon"))
    d = d.filter("batch_id <> 'B09-1'")
    wh = Warehouse(scratch_path(spark, "g"), home_days=7)
    merge_graph(spark, wh, k, d)
    assert set(wh.graph_store(spark).parts.parts("processed")) == {"2023-12-28", "2024-01-04", "undated"}
    merge_graph(spark, wh, k, d)
    for name, df in G.build_edges(k, d).as_dict().items():
        _same(df, getattr(wh.graph_edges(spark), name))


def test_empty_loads(spark):
    store = GraphStore(spark, scratch_path(spark, "g"), buckets=2)
    k, d = _graph_rows(spark, [1])
    store.merge(k.limit(0), d.limit(0))
    assert store.edges().processed.count() == 0 and store.nodes().count() == 0
    store.merge(k, d)
    store.merge(k.limit(0), d.limit(0))
    _same(G.build_edges(k, d).processed, store.edges().processed)
    assert G.ingredient_recall(store.edges(), "item0", "2024-03-01").count() == 0


# --- loads ----------------------------------------------------------------------

def _expect(spark, sf_small, store):
    c = warehouse_for(spark, sf_small).curated(spark)
    for name in ("kitchen", "dispatch", "dlq"):
        _same(getattr(c, name), store.read(name))
    _same(R.station_report(c.kitchen, "2024-01"), P.station_report(store.rollups(), "2024-01"))
    _same(R.ingredient_usage(c.kitchen, "2024-01"), P.ingredient_usage(store.rollups(), "2024-01"))
    _same(R.row_counts(c.kitchen, c.dispatch, c.dlq, "2024-01"), P.row_counts(store.rollups(), "2024-01"))
    _same(J.batch_exists(c.kitchen, c.dispatch, "BATCH-1229"), J.indexed_batch_exists(store.read("batch_dates"), "BATCH-1229"))


def test_loads_fail_between_tables_and_repeat_without_doubles(spark, sf_small, monkeypatch):
    root = scratch_path(spark, "loads")
    store = L.LoadStore(spark, f"{root}/t")
    source = RoutedFiles(warehouse_for(spark, sf_small).routed)
    good = L.derived_frames
    monkeypatch.setattr(L, "derived_frames", lambda stored: {
        n: df.withColumn("n", F.raise_error(F.lit("disk full")).cast("long")) if n == "rollup_rows" else df for n, df in good(stored).items()})
    with pytest.raises(Exception, match="disk full"):
        run_until_idle([L.start_loads(spark, source, store, f"{root}/ck", trigger=NOW)])
    assert store.read("kitchen").count() == 0 and store.loads() == []  # nothing of the load is seen
    done = sorted(store.files.names("rollup_stations/load=0"))
    assert store.files.exists("kitchen/load=0/_SUCCESS")
    monkeypatch.setattr(L, "derived_frames", good)
    run_until_idle([L.start_loads(spark, source, store, f"{root}/ck", trigger=NOW)])
    assert store.loads() == [0] and sorted(store.files.names("rollup_stations/load=0")) == done  # finished tables are not written again
    _expect(spark, sf_small, store)
    assert not store.write(0, {}) and store.loads() == [0]  # a repeated load adds nothing
    run_until_idle([L.start_loads(spark, source, store, f"{root}/ck", trigger=NOW)])
    _expect(spark, sf_small, store)


def test_compaction_rewrites_only_touched_dates(spark, sf_small):
    store = L.LoadStore(spark, scratch_path(spark, "loads"))
    routed = warehouse_for(spark, sf_small).routed_frame(spark)
    parts = [routed.filter(F.col("timestamp") < "2024-01-10"), routed.filter((F.col("timestamp") >= "2024-01-10") & (F.col("timestamp") < "2024-01-20")),
             routed.filter(F.col("timestamp") >= "2024-01-20")]
    assert store.compact() == [] and store.clean() == []
    store.write(0, L.load_frames(parts[0]), L.derived_frames)
    store.write(1, L.load_frames(parts[1]), L.derived_frames)
    assert store.compact() == [0, 1] and store.compact() == []
    before = store.manifest()["tables"]["kitchen"]
    held = store.read("kitchen")
    n = held.count()
    store.write(2, L.load_frames(parts[2]), L.derived_frames)
    _expect(spark, sf_small, store)  # compacted loads and a later one, each row once
    touched = set(store._touched(2)["kitchen"])
    assert store.compact() == [2]
    after = store.manifest()["tables"]["kitchen"]
    assert {d for d in after if after[d] != before.get(d)} == touched and set(before) - touched
    _expect(spark, sf_small, store)
    assert held.count() == n and not store.write(1, {}) and store.loads() == []
    time.sleep(0.05)
    gone = store.clean(keep=1, younger_than=0.01)
    assert {f"kitchen/load={i}" for i in range(3)} <= set(gone) and not store.files.names("_commits")
    assert all(not store.write(i, {}) for i in range(3))  # loads stay known after their commits are gone
    _expect(spark, sf_small, store)

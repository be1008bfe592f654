"""Report job (CSV per report and period) and publish keys."""

import os

import pytest

from pyspark.sql import functions as F

from batchtrace import schemas
from batchtrace.operators.ingest import with_message_key
from batchtrace.operators import reports as R
from batchtrace.operators.dlq import dlq_report, dlq_undated
from batchtrace.operators.reports import preview
from batchtrace.plans.report_job import write_period_reports
from batchtrace.session import is_local, local_path, scratch_path
from batchtrace.sinks.files import read_document_snapshot, write_document_snapshot
from catalog.stores import warehouse_for


def test_write_period_reports(spark, sf_small):
    c = warehouse_for(spark, sf_small).curated(spark)
    root = scratch_path(spark, "reports")
    day = write_period_reports(c, "2024-01-05", root)
    month = write_period_reports(c, "2024-01", root)
    assert set(day) == {"station", "recipe", "ingredient", "driver", "canteen", "dlq"}
    assert set(month) == set(day) | {"dlq_undated"}
    assert day["station"].endswith("daily/daily_station_2024-01-05")
    back = spark.read.option("header", "true").csv(month["station"])
    assert back.columns[0] == "station_id" and back.count() > 0
    empty_day = write_period_reports(c, "2023-06-01", root)
    assert "dlq" not in empty_day
    assert os.path.isdir(local_path(empty_day["station"]))


def test_keys_and_preview(spark, sf_small):
    routed = warehouse_for(spark, sf_small).routed_frame(spark)
    keyed = with_message_key(routed.drop("key"))
    # the fixture's keys are exactly the metadata event ids (null when absent)
    assert keyed.join(routed.select("value", F.col("key").alias("k0")), "value") \
                .filter(~F.col("key").eqNullSafe(F.col("k0"))).count() == 0
    k = warehouse_for(spark, sf_small).curated(spark).kitchen
    top = preview(k, 20).collect()
    assert len(top) == 20
    assert [r["event_timestamp"] for r in top] == sorted(r["event_timestamp"] for r in top)
    assert "TakeOrderedAndProject" in preview(k)._jdf.queryExecution().executedPlan().toString()


def test_kafka_sources_are_lazy_and_aimed(spark):
    """No Kafka connector here: check the reader options, not a connection."""
    from batchtrace.sources.topics import KafkaTopics, RoutedKafka
    k = KafkaTopics("broker:9092")
    rk = RoutedKafka(k)
    assert rk._topic("clean_kitchen") == "clean_kitchen_events"
    assert rk._topic("dlq") == "dead_letter_queue"
    assert k.starting_offsets == "earliest"


def test_load_curated_from_stored_paths(spark, sf_small):
    """S3: load the stored tables by path; a day's dead letters prune to its directory."""
    from batchtrace.plans.curated import load_curated
    wh = warehouse_for(spark, sf_small)
    loaded = load_curated(spark, wh.kitchen, wh.dispatch, wh.dlq)
    stored = wh.curated(spark)
    assert loaded.kitchen.count() == stored.kitchen.count()
    assert loaded.dispatch.count() == stored.dispatch.count()
    plan = dlq_report(loaded.dlq, "2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    cols = ["raw_message", "error_reason", "event_date"]
    a = sorted(map(tuple, loaded.dlq.select(*cols).collect()), key=str)
    b = sorted(map(tuple, stored.dlq.select(*cols).collect()), key=str)
    assert a == b


def test_limits_mean_what_they_say(spark, sf_small):
    from batchtrace.plans.report_job import display_reports
    c = warehouse_for(spark, sf_small).curated(spark)
    for report in (lambda n: R.kitchen_listing(c.kitchen, "2024-01", n), lambda n: R.dispatch_listing(c.dispatch, "2024-01", n),
                   lambda n: R.station_report(c.kitchen, "2024-01", n), lambda n: R.ingredient_usage(c.kitchen, "2024-01", n),
                   lambda n: dlq_report(c.dlq, "2024-01", n), lambda n: dlq_undated(c.dlq, n)):
        whole = report(None).collect()
        assert report(0).count() == 0 and report(3).collect() == whole[:3] and len(whole) > 3
    assert display_reports(c, "2024-01", "x")["station"].count() == 5
    assert display_reports(c, "2024-01", "2")["canteen"].count() == 2


def test_preview_of_raw_archives(spark, sf_small):
    raw = warehouse_for(spark, sf_small).raw_archive(spark, "dispatch")
    rows = preview(raw, 30).collect()
    assert [r.event_timestamp for r in rows] == sorted(r.event_timestamp for r in raw.collect())[:30]


def test_a_failed_snapshot_keeps_the_old_one(spark, sf_small):
    path = scratch_path(spark, "docs") + "/dispatch"
    d = warehouse_for(spark, sf_small).curated(spark).dispatch
    read = lambda: read_document_snapshot(spark, path, schemas.DISPATCH_CURATED)
    assert read().count() == 0
    write_document_snapshot(d, path)
    with pytest.raises(Exception, match="broken"):
        write_document_snapshot(d.withColumn("batch_id", F.raise_error(F.lit("broken")).cast("string")), path)
    assert read().count() == d.count()
    write_document_snapshot(d.limit(3), path)
    assert read().count() == 3


def test_stored_tables_are_laid_out_for_lookups(spark, sf_small):
    import pyarrow.parquet as pq
    wh = warehouse_for(spark, sf_small)
    files = wh.curated(spark).kitchen.inputFiles()
    days = {f.split("event_date=")[1].split("/")[0] for f in files}
    assert len(files) <= 2 * len(days) + 4
    for f in files[:5]:
        ids = pq.read_table(local_path(f), columns=["batch_id"], partitioning=None)["batch_id"].to_pylist()
        assert ids == sorted(ids, key=lambda x: (x is not None, x or ""))


def test_local_masters():
    assert is_local("local") and is_local("local[4]") and not is_local("local-cluster[3,2,1024]") and not is_local("yarn")


def test_thresholds_from_a_file(tmp_path):
    from batchtrace.config import Thresholds
    (tmp_path / "c.json").write_text('{"max_truck_temp": 7, "other": 1}')
    assert Thresholds.from_json_file(tmp_path / "c.json") == Thresholds(max_truck_temp=7.0)
    assert Thresholds.from_json_file(tmp_path / "none.json") == Thresholds()


def test_a_failed_report_keeps_the_old_one(spark, sf_small):
    from batchtrace.sinks.files import write_csv_report
    path = scratch_path(spark, "report") + "/monthly_station"
    report = R.station_report(warehouse_for(spark, sf_small).curated(spark).kitchen, "2024-01")
    write_csv_report(report, path)
    n = report.count()
    with pytest.raises(Exception, match="broken"):
        write_csv_report(report.withColumn("station_id", F.raise_error(F.lit("broken")).cast("string")), path)
    assert spark.read.option("header", "true").csv(path).count() == n
    write_csv_report(report.limit(2), path + "/")
    assert spark.read.option("header", "true").csv(path).count() == 2
    assert os.listdir(os.path.dirname(local_path(path))) == ["monthly_station"]


def test_snapshots_roll_back_and_are_cleaned(spark, sf_small):
    from batchtrace.sinks.files import clean_document_snapshots, roll_back_document_snapshot
    path = scratch_path(spark, "docs") + "/dispatch"
    d = warehouse_for(spark, sf_small).curated(spark).dispatch
    for n in (1, 2, 3):
        write_document_snapshot(d.limit(n), path)
    read = lambda: read_document_snapshot(spark, path, schemas.DISPATCH_CURATED).count()
    roll_back_document_snapshot(spark, path)
    assert read() == 2 and clean_document_snapshots(spark, path) == []
    assert len(clean_document_snapshots(spark, path, keep=1, younger_than=0.0)) == 2 and read() == 2

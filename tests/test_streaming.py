"""Stream = batch, several micro-batches, and restart adds nothing."""

import pytest
from pyspark.sql import functions as F

from batchtrace import schemas
from batchtrace.plans.curated import curate
from batchtrace.session import scratch_path
from batchtrace.sinks.files import compact_table
from batchtrace.sources.topics import FileTopics, RoutedFiles, publish_files
from batchtrace.streaming.pipeline import (PipelinePaths, await_any, kafka_messages, run_until_idle, start_pipeline,
                                           start_router)
from catalog.stores import warehouse_for

NOW = {"availableNow": True}


def _rows(df, cols):
    rows = [tuple(r) for r in df.select(*cols).collect()]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_router_and_pipeline_equal_batch(spark, sf_small):
    root = scratch_path(spark, "test-stream")
    raw = warehouse_for(spark, sf_small).routed_frame(spark).select(*schemas.RAW_MESSAGE.fieldNames())
    for part in range(3):  # three publishers: three files a topic
        publish_files(raw.filter(F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(3)) == part).coalesce(1), f"{root}/topics")
    topics = FileTopics(f"{root}/topics", max_files_per_trigger=1)

    router = start_router(spark, topics, f"{root}/routed", f"{root}/ckpt/router", trigger=NOW)
    run_until_idle([router])
    assert len(router.recentProgress) >= 3  # one file per micro-batch
    routed = spark.read.schema(schemas.ROUTED).parquet(f"{root}/routed")
    assert routed.count() == raw.count()

    # Restart over the same input and checkpoint: nothing new is written.
    again = start_router(spark, topics, f"{root}/routed", f"{root}/ckpt/router", trigger=NOW)
    run_until_idle([again])
    assert spark.read.schema(schemas.ROUTED).parquet(f"{root}/routed").count() == raw.count()

    paths = PipelinePaths(f"{root}/tables")
    qs = start_pipeline(spark, RoutedFiles(f"{root}/routed", max_files_per_trigger=2), paths, trigger=NOW)
    assert set(qs) == {"raw_kitchen", "kitchen", "raw_dispatch", "dispatch", "dlq"}
    run_until_idle(qs)

    batch = curate(raw)
    k_cols = [c for c in schemas.KITCHEN_CURATED.fieldNames() if c != "ingredients"]
    d_cols = schemas.DISPATCH_CURATED.fieldNames()
    q_cols = schemas.DLQ_CLASSIFIED.fieldNames()
    read = lambda name, sch: spark.read.schema(sch).parquet(paths.table(name))
    assert _rows(read("kitchen", schemas.KITCHEN_CURATED), k_cols) == _rows(batch.kitchen, k_cols)
    assert _rows(read("dispatch", schemas.DISPATCH_CURATED), d_cols) == _rows(batch.dispatch, d_cols)
    assert _rows(read("dlq", schemas.DLQ_CLASSIFIED), q_cols) == _rows(batch.dlq, q_cols)
    assert read("raw_kitchen", schemas.RAW_ARCHIVE).count() == batch.kitchen.count()
    assert read("raw_dispatch", schemas.RAW_ARCHIVE).count() == batch.dispatch.count()
    compact_table(spark, paths.table("kitchen"), schemas.KITCHEN_CURATED, f"{root}/compact", "batch_id", ("event_date",))
    small = spark.read.schema(schemas.KITCHEN_CURATED).parquet(f"{root}/compact")
    assert _rows(small, k_cols) == _rows(batch.kitchen, k_cols)
    assert len(small.inputFiles()) <= len(read("kitchen", schemas.KITCHEN_CURATED).inputFiles())


def test_partition_pruning_on_stored_tables(spark, sf_small):
    from batchtrace.operators.reports import station_report
    k = warehouse_for(spark, sf_small).curated(spark).kitchen
    plan = station_report(k, "2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-05" in plan
    month = station_report(k, "2024-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in month and "2024-02-01" in month


def test_restart_takes_only_new_input(spark, sf_small):
    root = scratch_path(spark, "test-restart")
    raw = warehouse_for(spark, sf_small).routed_frame(spark).select(*schemas.RAW_MESSAGE.fieldNames())
    first = raw.filter(F.col("timestamp") < F.lit("2024-01-15").cast("timestamp_ntz"))
    rest = raw.filter(F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    topics = FileTopics(f"{root}/topics")
    out, ckpt = f"{root}/routed", f"{root}/ckpt"
    publish_files(first, f"{root}/topics")
    run_until_idle([start_router(spark, topics, out, ckpt, trigger=NOW)])
    n1 = spark.read.schema(schemas.ROUTED).parquet(out).count()
    assert n1 == first.count()
    publish_files(rest, f"{root}/topics")
    run_until_idle([start_router(spark, topics, out, ckpt, trigger=NOW)])
    final = spark.read.schema(schemas.ROUTED).parquet(out)
    assert final.count() == raw.count()
    assert final.select("value", "timestamp").distinct().count() == raw.count()


def _live(spark, root, fail=False):
    """A rate stream that runs on, or fails in its first batch with rows."""
    def each(df, _):
        if fail and df.count():
            raise ValueError("broken sink")
    return (spark.readStream.format("rate").option("rowsPerSecond", 50).load().writeStream
            .option("checkpointLocation", f"{root}/c").foreachBatch(each).start())


def test_timeout_is_an_error(spark):
    q = _live(spark, scratch_path(spark, "live"))
    with pytest.raises(TimeoutError):
        run_until_idle([q], timeout=1)
    assert not q.isActive


def test_await_any_waits_for_the_given_queries_only(spark, sf_small):
    root = scratch_path(spark, "any")
    raw = warehouse_for(spark, sf_small).routed_frame(spark).select(*schemas.RAW_MESSAGE.fieldNames()).limit(20)
    publish_files(raw, f"{root}/topics")
    earlier = start_router(spark, FileTopics(f"{root}/topics"), f"{root}/o", f"{root}/ck", trigger=NOW)
    run_until_idle([earlier])  # a stream of the session has ended before
    a, b = _live(spark, f"{root}/a"), _live(spark, f"{root}/b")
    with pytest.raises(TimeoutError):
        await_any([a, b], timeout=2)
    assert not a.isActive and not b.isActive
    again = start_router(spark, FileTopics(f"{root}/topics"), f"{root}/o", f"{root}/ck", trigger=NOW)
    c = _live(spark, f"{root}/c")
    assert await_any([c, again], timeout=60) is again and not c.isActive
    good, bad = _live(spark, f"{root}/d"), _live(spark, f"{root}/e", fail=True)
    with pytest.raises(RuntimeError, match="broken sink"):
        await_any({"good": good, "bad": bad}, timeout=60)
    assert not good.isActive


def test_kafka_messages(spark, sf_small):
    routed = warehouse_for(spark, sf_small).routed_frame(spark)
    out = kafka_messages(routed)
    assert out.columns == ["key", "value", "topic"]
    assert {r.topic for r in out.select("topic").distinct().collect()} == {
        "clean_kitchen_events", "clean_dispatch_events", "dead_letter_queue"}

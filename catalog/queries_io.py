"""Streaming, sink and preview queries (registered on import).

The streaming queries run the real Structured Streaming jobs with an
``availableNow`` trigger over file topics in the shared scratch folder, then
read the committed output; their oracles are the batch answers.
"""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import functions as F

from batchtrace import schemas
from batchtrace.config import Topics
from batchtrace.operators import reports as R
from batchtrace.plans import rollups as P
from batchtrace.functions.period import row_limit
from batchtrace.operators.journey import batch_journey
from batchtrace.plans.report_job import display_reports, write_period_reports
from batchtrace.session import scratch_path
from batchtrace.sinks.files import (compact_table, read_csv_report, read_document_snapshot, write_csv_report,
                                    write_document_snapshot)
from batchtrace.sources.message_log import LogTopics, TopicFiles, publish
from batchtrace.sources.topics import FileTopics, RoutedFiles, publish_files
from batchtrace.streaming.loads import LoadStore, start_loads
from batchtrace.streaming.pipeline import PipelinePaths, run_until_idle, start_pipeline, start_router
from catalog import oracle as O
from catalog.fixture import load_raw_messages
from catalog.queries import BATCH, DAY, DISPATCH_FLAG_COLUMNS, KITCHEN_FLAG_COLUMNS, MONTH, SQL, _c, register
from catalog.queries_more import q_batch_journey  # noqa: F401  (registers the journey's SQL)
from catalog.stores import warehouse_for

_AVAILABLE_NOW = {"availableNow": True}
#: Loads that the stored messages are taken in, however many files they are.
_LOADS = 4


def _run_router(spark, sf_dir, root: str) -> str:
    """Raw messages published as file topics and routed by the stream."""
    publish_files(load_raw_messages(spark, sf_dir), f"{root}/topics")
    out = f"{root}/routed"
    router = start_router(spark, FileTopics(f"{root}/topics"), out, f"{root}/_checkpoints/router", trigger=_AVAILABLE_NOW)
    run_until_idle([router])
    return out


def _streamed(spark, sf_dir) -> PipelinePaths:
    """All five tables as the streaming jobs write them, from the raw messages on."""
    root = scratch_path(spark, "stream")
    paths = PipelinePaths(f"{root}/tables")
    run_until_idle(start_pipeline(spark, RoutedFiles(_run_router(spark, sf_dir, root)), paths, trigger=_AVAILABLE_NOW))
    return paths


@register("stream_route", SQL["envelope_validation"])
def q_stream_route(spark, sf_dir):
    out = _run_router(spark, sf_dir, scratch_path(spark, "stream-route"))
    return (spark.read.schema(schemas.ROUTED).parquet(out)
            .select("key", "topic", "timestamp", "is_valid", "route"))


def _topic_log(spark, sf_dir) -> LogTopics:
    """All raw messages published to a topic log with offsets."""
    root = scratch_path(spark, "log")
    publish(load_raw_messages(spark, sf_dir), f"{root}/topics")
    return LogTopics(f"{root}/topics")


@register("stream_route_log", SQL["envelope_validation"])
def q_stream_route_log(spark, sf_dir):
    """The router over a source with offsets (S1, S7, S12)."""
    source, root = _topic_log(spark, sf_dir), scratch_path(spark, "log-route")
    run_until_idle([start_router(spark, source, f"{root}/routed", f"{root}/_checkpoints/router", trigger=_AVAILABLE_NOW)])
    return (spark.read.schema(schemas.ROUTED).parquet(f"{root}/routed")
            .select("key", "topic", "timestamp", "is_valid", "route"))


@register("topic_scan_offsets", O.with_ctes(
    "SELECT topic, \"key\", \"value\", \"timestamp\" FROM raw WHERE topic IN ('kitchen_station_events', 'dispatch_events')"))
def q_topic_scan_offsets(spark, sf_dir):
    """Bounded scans between offsets (S2): up to a middle offset of every partition, and on from there."""
    source, topics = _topic_log(spark, sf_dir), [Topics().kitchen, Topics().dispatch]
    files = TopicFiles(source.root)
    middle = json.dumps({t: {str(p): files.bounds(t, p)[1] // 2 for p in files.partitions(t)} for t in topics})
    before, after = replace(source, ending_offsets=middle), replace(source, starting_offsets=middle)
    return before.batch(spark, topics).unionAll(after.batch(spark, topics)).select("topic", "key", "value", "timestamp")


@register("stream_curated", SQL["kitchen_flags"])
def q_stream_curated(spark, sf_dir):
    """The streamed kitchen table, compacted into a lookup table."""
    paths = _streamed(spark, sf_dir)
    out = paths.table("kitchen_compacted")
    compact_table(spark, paths.table("kitchen"), schemas.KITCHEN_CURATED, out, "batch_id", ("event_date",))
    return spark.read.schema(schemas.KITCHEN_CURATED).parquet(out).select(*KITCHEN_FLAG_COLUMNS)


@register("stream_dispatch", SQL["dispatch_flags"])
def q_stream_dispatch(spark, sf_dir):
    return (spark.read.schema(schemas.DISPATCH_CURATED).parquet(_streamed(spark, sf_dir).table("dispatch"))
            .select(*DISPATCH_FLAG_COLUMNS))


@register("stream_raw", SQL["raw_archive"])
def q_stream_raw(spark, sf_dir):
    paths = _streamed(spark, sf_dir)
    parts = [spark.read.schema(schemas.RAW_ARCHIVE).parquet(paths.table(t)).withColumn("archive", F.lit(t))
             for t in ("raw_kitchen", "raw_dispatch")]
    return parts[0].unionByName(parts[1])


_DLQ_COLUMNS = ("message_key", "raw_message", "payload_timestamp", "event_id", "batch_id", "error_reason", "event_date")


@register("stream_dlq", O.with_ctes("SELECT " + ", ".join(_DLQ_COLUMNS) + " FROM dlq"))
def q_stream_dlq(spark, sf_dir):
    return (spark.read.schema(schemas.DLQ_CLASSIFIED).parquet(_streamed(spark, sf_dir).table("dlq"))
            .select(*_DLQ_COLUMNS))


def _loaded(spark, sf_dir) -> LoadStore:
    """All tables by the one-query ingest of the stored routed messages, in several loads, then compacted.

    A load is two files, or more if that made more than ``_LOADS`` loads: each has a dozen
    tables to write, and two files keep two tasks busy, so small loads leave a cluster idle.
    """
    root = scratch_path(spark, "loads")
    store = LoadStore(spark, f"{root}/tables")
    wh = warehouse_for(spark, sf_dir)
    files = len(wh.routed_frame(spark).inputFiles())
    routed = RoutedFiles(wh.routed, max_files_per_trigger=max(2, -(-files // _LOADS)))
    run_until_idle([start_loads(spark, routed, store, f"{root}/_checkpoints/loads",
                                trigger=_AVAILABLE_NOW)])
    store.compact()
    return store


@register("loads_curated", O.with_ctes(
    "SELECT 'kitchen' AS part, event_id, batch_id, event_timestamp, sensor_status, temperature_status, event_date FROM kitchen "
    "UNION ALL SELECT 'dispatch', event_id, batch_id, event_timestamp, sensor_status, temperature_status, event_date FROM dispatch "
    "UNION ALL SELECT 'dlq', event_id, batch_id, payload_timestamp, NULL, error_reason, event_date FROM dlq"))
def q_loads_curated(spark, sf_dir):
    """The three tables that one stream's loads feed together, after compaction (T1, S5, S6)."""
    store = _loaded(spark, sf_dir)
    columns = ["event_id", "batch_id", "event_timestamp", "sensor_status", "temperature_status", "event_date"]
    dlq = store.read("dlq").select("event_id", "batch_id", F.col("payload_timestamp").alias("event_timestamp"),
                                   F.lit(None).cast("string").alias("sensor_status"),
                                   F.col("error_reason").alias("temperature_status"), "event_date")
    out = store.read("kitchen").select(F.lit("kitchen").alias("part"), *columns)
    return out.unionByName(store.read("dispatch").select(F.lit("dispatch").alias("part"), *columns)) \
        .unionByName(dlq.select(F.lit("dlq").alias("part"), *columns))


@register("loads_station_report_month", SQL["station_report_month"])
def q_loads_station_report_month(spark, sf_dir):
    """The monthly report from the partials that the loads kept."""
    return P.station_report(_loaded(spark, sf_dir).rollups(), MONTH)


@register("dlq_messages", O.with_ctes(
    "SELECT \"key\" AS message_key, \"value\" AS error_payload, \"timestamp\" FROM routed WHERE route = 'dlq'"))
def q_dlq_messages(spark, sf_dir):
    """Bounded scan of the dead-letter topic (S2)."""
    return (RoutedFiles(warehouse_for(spark, sf_dir).routed).batch(spark, "dlq")
            .select(F.col("key").alias("message_key"), F.col("value").alias("error_payload"), "timestamp"))


_STATION_SCHEMA = "station_id STRING, total_times_active BIGINT, total_temp_warnings BIGINT, " \
                  "total_weight_warnings BIGINT, total_sensor_warnings BIGINT"


@register("csv_report_roundtrip", SQL["station_report_month"])
def q_csv_report_roundtrip(spark, sf_dir):
    """Monthly station report written as a CSV report and read back (S8)."""
    path = scratch_path(spark, "report") + f"/monthly_station_{MONTH.label}"
    write_csv_report(R.station_report(_c(spark, sf_dir).kitchen, MONTH), path)
    return read_csv_report(spark, path, spark.createDataFrame([], _STATION_SCHEMA).schema)


#: Every report of a day and a month: report name -> (its SQL, text columns, number columns).
_REPORT_FILES = {
    f"{kind}_{name}": (SQL[f"{query}_{period}"], texts, numbers)
    for kind, period in (("daily", "day"), ("monthly", "month"))
    for name, query, texts, numbers in (
        ("station", "station_report", ("station_id",),
         ("total_times_active", "total_temp_warnings", "total_weight_warnings", "total_sensor_warnings")),
        ("recipe", "recipe_report", ("recipe_id",), ("total_times_cooked",)),
        ("ingredient", "ingredient_usage", ("recipe_id", "item"), ("total_weight_used",)),
        ("driver", "driver_report", ("driver_id",), ("total_deliveries", "total_truck_temp_warnings", "total_sensor_warnings")),
        ("canteen", "canteen_report", ("canteen_id",), ("total_deliveries",)),
        ("dlq", "dlq_report", ("payload_timestamp", "event_id", "batch_id", "error_reason"), ()))
} | {"unknown_timestamp_dlq": (SQL["dlq_report_undated"], ("payload_timestamp", "event_id", "batch_id", "error_reason"), ())}


def _report_files_sql() -> str:
    def one(name: str, sql: str, texts, numbers) -> str:
        columns = [f"CAST({t} AS VARCHAR) AS t{i}" for i, t in enumerate(texts)]
        columns += [f"CAST(NULL AS VARCHAR) AS t{i}" for i in range(len(texts), 4)]
        columns += [f"CAST({n} AS DOUBLE) AS n{i}" for i, n in enumerate(numbers)]
        columns += [f"CAST(NULL AS DOUBLE) AS n{i}" for i in range(len(numbers), 4)]
        return f"SELECT '{name}' AS report, {', '.join(columns)} FROM ({sql})"
    return " UNION ALL ".join(one(name, *spec) for name, spec in _REPORT_FILES.items())


@register("csv_report_files", _report_files_sql())
def q_csv_report_files(spark, sf_dir):
    """The report job for a day and a month: all thirteen CSV reports, written twice, read back (S8)."""
    root, c, paths = scratch_path(spark, "reports"), _c(spark, sf_dir), {}
    for period in (DAY, MONTH, DAY):
        kind = "daily" if period.kind == "day" else "monthly"
        for report, path in write_period_reports(c, period, root).items():
            paths["unknown_timestamp_dlq" if report == "dlq_undated" else f"{kind}_{report}"] = path
    out = None
    for name in paths:  # dead letters have a file only where there are some
        _, texts, numbers = _REPORT_FILES[name]
        schema = ", ".join([f"{t} STRING" for t in texts] + [f"{n} DOUBLE" for n in numbers])
        df = spark.read.option("header", "true").schema(schema).csv(paths[name])
        columns = [(F.col(texts[i]) if i < len(texts) else F.lit(None).cast("string")).alias(f"t{i}") for i in range(4)]
        columns += [(F.col(numbers[i]) if i < len(numbers) else F.lit(None).cast("double")).alias(f"n{i}") for i in range(4)]
        part = df.select(F.lit(name).alias("report"), *columns)
        out = part if out is None else out.unionAll(part)
    return out


@register("text_parameters", " UNION ALL ".join([
    f"SELECT 'day' AS report, station_id AS id, total_times_active AS n FROM ({SQL['station_report_day']} ORDER BY station_id NULLS FIRST LIMIT 3)",
    f"SELECT 'month', driver_id, total_deliveries FROM ({SQL['driver_report_month']} ORDER BY driver_id NULLS FIRST LIMIT 5)",
    f"SELECT 'batch', batch_id, count(*) FROM ({SQL['batch_journey']}) GROUP BY batch_id"]))
def q_text_parameters(spark, sf_dir):
    """Reports asked for by text, as typed: a day, a month, row limits and a batch id (P22)."""
    c = _c(spark, sf_dir)
    day = R.station_report(c.kitchen, f" {DAY.label} ", row_limit("3"))
    month = R.driver_report(c.dispatch, MONTH.label, row_limit("many"))
    batch = batch_journey(c.kitchen, c.dispatch, f" {BATCH}\n")
    return (day.select(F.lit("day").alias("report"), F.col("station_id").alias("id"), F.col("total_times_active").alias("n"))
            .unionAll(month.select(F.lit("month"), "driver_id", "total_deliveries"))
            .unionAll(batch.groupBy("batch_id").count().select(F.lit("batch"), "batch_id", "count")))


_DOC_COLUMNS = KITCHEN_FLAG_COLUMNS + ("n_ingredients",)


@register("document_snapshot", O.with_ctes(
    "SELECT " + ", ".join(KITCHEN_FLAG_COLUMNS) + ", CAST(len(ingredients) AS BIGINT) AS n_ingredients FROM kitchen"))
def q_document_snapshot(spark, sf_dir):
    """Kitchen rows replaced into a document collection (nested ingredients
    kept as nested documents), read back (S9)."""
    path = scratch_path(spark, "documents") + "/kitchen_events"
    write_document_snapshot(_c(spark, sf_dir).kitchen, path)
    back = read_document_snapshot(spark, path, schemas.KITCHEN_CURATED)
    return back.withColumn("n_ingredients", F.size("ingredients").cast("long")).select(*_DOC_COLUMNS)


@register("document_snapshot_dispatch", SQL["dispatch_flags"])
def q_document_snapshot_dispatch(spark, sf_dir):
    """The second collection: replaced twice, the later snapshot is read."""
    path = scratch_path(spark, "documents") + "/dispatch_events"
    dispatch = _c(spark, sf_dir).dispatch
    write_document_snapshot(dispatch.filter(F.col("driver_id").isNull()), path)
    write_document_snapshot(dispatch, path)
    return read_document_snapshot(spark, path, schemas.DISPATCH_CURATED).select(*DISPATCH_FLAG_COLUMNS)


@register("station_report_top5", SQL["station_report_day"] + " ORDER BY station_id NULLS FIRST LIMIT 5")
def q_station_report_top5(spark, sf_dir):
    """A report cut to the default number of display rows (L3)."""
    return display_reports(_c(spark, sf_dir), DAY)["station"]


@register("preview_raw_top200", O.with_ctes(
    "SELECT \"key\" AS message_key, \"value\" AS raw_message, \"timestamp\" AS event_timestamp FROM routed "
    "WHERE route = 'clean_kitchen' ORDER BY \"timestamp\" NULLS FIRST, \"key\" NULLS FIRST, \"value\" LIMIT 200"))
def q_preview_raw_top200(spark, sf_dir):
    """First 200 rows of a raw archive by ingest time and key (S11)."""
    return R.preview(warehouse_for(spark, sf_dir).raw_archive(spark, "kitchen"))


@register("preview_top200", O.with_ctes(
    "SELECT " + ", ".join(KITCHEN_FLAG_COLUMNS) + " FROM kitchen ORDER BY event_timestamp, event_id LIMIT 200"))
def q_preview_top200(spark, sf_dir):
    """First 200 kitchen rows by time (S11); the limit is the feature."""
    return R.preview(_c(spark, sf_dir).kitchen).select(*KITCHEN_FLAG_COLUMNS)

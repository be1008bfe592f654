"""Structured Streaming jobs: the router and the five-table ingest pipeline.

Both are stateless per-row projections (no shuffle, no state store), written
with the Parquet file sink, whose commit log makes each micro-batch
exactly-once: a restart from the checkpoint re-runs only uncommitted batches
and a lost executor re-runs only its tasks. Checkpoints belong in shared
storage (the session's checkpoint folder by default).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from batchtrace import config as C
from batchtrace import schemas
from batchtrace.operators.dlq import classify_dlq
from batchtrace.operators.ingest import decode_raw, route, route_topic_column
from batchtrace.plans.curated import dispatch_from_clean, kitchen_from_clean


def _apply_trigger(writer, trigger: dict | None):
    # e.g. {"availableNow": True}, {"processingTime": "10 seconds"}; None = as fast as possible.
    return writer.trigger(**trigger) if trigger else writer


def start_router(spark: SparkSession, source, out_path: str, checkpoint: str,
                 topics: C.Topics = C.Topics(), trigger: dict | None = None,
                 name: str | None = None) -> StreamingQuery:
    """Validate-and-route job (T4 / S7): both input topics in, every
    subscribed message out with ``is_valid``, one directory per ``route``."""
    routed = route(source.stream(spark, [topics.kitchen, topics.dispatch]), topics)
    w = (routed.select(*schemas.ROUTED.fieldNames())
         .writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .partitionBy("route"))
    if name:
        w = w.queryName(name)
    return _apply_trigger(w, trigger).start()


def kafka_messages(routed: DataFrame, topics: C.Topics = C.Topics()) -> DataFrame:
    """Routed messages as a Kafka sink takes them: key, value, destination topic."""
    return routed.select("key", "value", route_topic_column(routed["route"], topics).alias("topic"))


def start_kafka_router(spark: SparkSession, source, bootstrap_servers: str, checkpoint: str,
                       topics: C.Topics = C.Topics(), trigger: dict | None = None) -> StreamingQuery:
    """The same router publishing to the clean / dead-letter Kafka topics,
    message key preserved (needs the Kafka connector)."""
    routed = route(source.stream(spark, [topics.kitchen, topics.dispatch]), topics)
    w = (kafka_messages(routed, topics).writeStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("checkpointLocation", checkpoint))
    return _apply_trigger(w, trigger).start()


@dataclass(frozen=True)
class PipelinePaths:
    """Output tables and one checkpoint folder per query."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


PIPELINE_TABLES = ("raw_kitchen", "kitchen", "raw_dispatch", "dispatch", "dlq")


def start_pipeline(spark: SparkSession, source, paths: PipelinePaths,
                   thresholds: C.Thresholds = C.Thresholds(),
                   trigger: dict | None = None) -> dict[str, StreamingQuery]:
    """The five append queries (T1): raw archive and curated table of each
    clean topic, and the classified dead letters. ``source`` is a routed
    source with ``stream(spark, route)`` (router files or Kafka clean topics).
    Curated tables and dead letters are partitioned by ``event_date``."""
    clean_k = source.stream(spark, C.ROUTE_CLEAN_KITCHEN)
    clean_d = source.stream(spark, C.ROUTE_CLEAN_DISPATCH)
    dead = source.stream(spark, C.ROUTE_DLQ)
    plans: dict[str, tuple[DataFrame, tuple[str, ...]]] = {
        "raw_kitchen": (decode_raw(clean_k), ()),
        "kitchen": (kitchen_from_clean(clean_k, thresholds)
                    .select(*schemas.KITCHEN_CURATED.fieldNames()), ("event_date",)),
        "raw_dispatch": (decode_raw(clean_d), ()),
        "dispatch": (dispatch_from_clean(clean_d, thresholds)
                     .select(*schemas.DISPATCH_CURATED.fieldNames()), ("event_date",)),
        "dlq": (classify_dlq(decode_raw(dead)).select(*schemas.DLQ_CLASSIFIED.fieldNames()),
                ("event_date",)),
    }
    queries: dict[str, StreamingQuery] = {}
    try:
        for name, (df, parts) in plans.items():
            w = (df.writeStream.format("parquet").outputMode("append")
                 .option("path", paths.table(name))
                 .option("checkpointLocation", paths.checkpoint(name)))
            if parts:
                w = w.partitionBy(*parts)
            queries[name] = _apply_trigger(w, trigger).start()
    except Exception:
        stop_all(queries)
        raise
    return queries


def stop_all(queries) -> None:
    """Stop every query that is still active (T3 cleanup)."""
    for q in (queries.values() if isinstance(queries, dict) else queries):
        if q is not None and q.isActive:
            q.stop()


def _listed(queries) -> list[StreamingQuery]:
    return list(queries.values()) if isinstance(queries, dict) else list(queries)


def _raise_failure(q: StreamingQuery) -> None:
    if q.exception() is not None:
        raise RuntimeError(f"stream {q.name or q.id} failed: {q.exception()}")


def run_until_idle(queries, timeout: float | None = None) -> None:
    """Wait for bounded (``availableNow``) queries to finish, surfacing the
    first failure; stops all on the way out. ``timeout`` (seconds, for all of
    them) raises ``TimeoutError``: unfinished output is never taken as whole."""
    qs = _listed(queries)
    end = None if timeout is None else time.monotonic() + timeout
    try:
        for q in qs:
            try:
                finished = q.awaitTermination(None if end is None else max(0.0, end - time.monotonic()))
            except StreamingQueryException:
                finished = True
            _raise_failure(q)
            if end is not None and not finished:
                raise TimeoutError(f"stream {q.name or q.id} did not finish in {timeout} s")
    finally:
        stop_all(qs)


def await_any(queries, timeout: float | None = None, poll: float = 0.2) -> StreamingQuery:
    """Block until one of the given queries ends, stop the others, and return
    it (T3). Raises its failure, or ``TimeoutError`` after ``timeout`` seconds.
    Other streams of the session, earlier or running, do not matter."""
    qs = _listed(queries)
    end = None if timeout is None else time.monotonic() + timeout
    try:
        while True:
            for q in qs:
                if not q.isActive:
                    _raise_failure(q)
                    return q
            if end is not None and time.monotonic() >= end:
                raise TimeoutError(f"no stream ended in {timeout} s")
            time.sleep(poll)
    finally:
        stop_all(qs)

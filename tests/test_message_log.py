"""The topic log: offsets, bounded scans, restarts, publishing, without a broker."""

import json
import os

import pytest
from pyspark.sql import functions as F

from batchtrace import schemas
from batchtrace.session import local_path, scratch_path
from batchtrace.sources.message_log import LogTopics, TopicFiles, publish
from batchtrace.streaming.pipeline import run_until_idle, start_router
from catalog.stores import warehouse_for

NOW = {"availableNow": True}


def _messages(spark, n, start=0, topic="t"):
    return spark.range(start, start + n).select(
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("k"), (F.col("id") % 5).cast("string"))).alias("key"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("value"),
        F.lit(topic).alias("topic"), F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("timestamp"))


def _values(df):
    return sorted(int(r.value[1:]) for r in df.collect())


def test_offsets_of_a_partition_run_on(spark):
    root = scratch_path(spark, "log")
    publish(_messages(spark, 100).repartition(3), root, partitions=3)
    publish(_messages(spark, 50, 100), root, partitions=3)
    rows = LogTopics(root).batch_offsets(spark, ["t"]).collect()
    assert sorted(r.value for r in rows) == sorted(f"v{i}" for i in range(150))
    for p in range(3):
        mine = sorted(r.offset for r in rows if r.partition == p)
        assert mine == list(range(len(mine)))
    keys = {}
    for r in rows:
        keys.setdefault(r.key, set()).add(r.partition)
    assert all(len(ps) == 1 for k, ps in keys.items() if k)
    assert {r.timestamp.second for r in rows if r.value == "v7"} == {7}


def test_starting_and_ending_offsets(spark):
    root = scratch_path(spark, "log")
    publish(_messages(spark, 40), root, partitions=1)
    publish(_messages(spark, 20, 40), root, partitions=1)
    every = {r.offset: int(r.value[1:]) for r in LogTopics(root).batch_offsets(spark, ["t"]).collect()}
    at = lambda first, last: LogTopics(root, json.dumps({"t": {"0": first}}), json.dumps({"t": {"0": last}}), offsets_per_split=7)
    for first, last in ((5, 45), (-2, 10), (50, -1), (60, 60), (0, 60)):
        low, high = 0 if first == -2 else first, 60 if last == -1 else last
        df = at(first, last).batch(spark, ["t"])
        assert _values(df) == sorted(every[o] for o in range(low, high))
    assert at(5, 45).batch(spark, ["t"]).rdd.getNumPartitions() == 6
    assert LogTopics(root, "latest").batch(spark, ["t"]).count() == 0
    assert LogTopics(root).batch(spark, ["other"]).count() == 0
    with pytest.raises(Exception, match="not within"):
        at(61, 70).batch(spark, ["t"]).count()
    with pytest.raises(Exception, match="subscribe"):
        LogTopics(root).batch(spark, []).count()


def _run(spark, source, root, out="out"):
    q = (source.stream_offsets(spark, ["t"]).writeStream.format("parquet").option("path", f"{root}/{out}")
         .option("checkpointLocation", f"{root}/ck-{out}").trigger(**NOW).start())
    run_until_idle([q])
    return q


def test_a_stream_restarts_at_its_offsets(spark):
    root = scratch_path(spark, "log")
    publish(_messages(spark, 30), f"{root}/log", partitions=2)
    read = lambda out="out": _values(spark.read.schema("value string").parquet(f"{root}/{out}"))
    _run(spark, LogTopics(f"{root}/log"), root)
    assert read() == list(range(30))
    _run(spark, LogTopics(f"{root}/log"), root)  # nothing new
    publish(_messages(spark, 12, 30), f"{root}/log", partitions=2)
    _run(spark, LogTopics(f"{root}/log", "latest"), root)  # the checkpoint says where to go on
    assert read() == list(range(42))


def test_streams_start_where_they_are_told(spark):
    root = scratch_path(spark, "log")
    publish(_messages(spark, 30), f"{root}/log", partitions=1)
    by_offset = {r.offset: int(r.value[1:]) for r in LogTopics(f"{root}/log").batch_offsets(spark, ["t"]).collect()}
    _run(spark, LogTopics(f"{root}/log", json.dumps({"t": {"0": 18}})), root, "late")
    assert _values(spark.read.schema("value string").parquet(f"{root}/late")) == sorted(by_offset[o] for o in range(18, 30))


def test_the_router_reads_a_topic_log(spark, sf_small):
    root = scratch_path(spark, "log")
    raw = warehouse_for(spark, sf_small).routed_frame(spark).select(*schemas.RAW_MESSAGE.fieldNames())
    publish(raw, f"{root}/log")
    run_until_idle([start_router(spark, LogTopics(f"{root}/log"), f"{root}/routed", f"{root}/ck", trigger=NOW)])
    back = spark.read.schema(schemas.ROUTED).parquet(f"{root}/routed")
    want = warehouse_for(spark, sf_small).routed_frame(spark)
    assert back.exceptAll(want.select(*back.columns)).count() == 0 and back.count() == want.count()


def test_a_failed_publish_adds_nothing(spark):
    root = scratch_path(spark, "log")
    publish(_messages(spark, 10), root)
    bad = _messages(spark, 10, 10).withColumn("value", F.when(F.col("value") == "v17", F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="broken"):
        publish(bad, root)
    assert _values(LogTopics(root).batch(spark, ["t"])) == list(range(10))
    publish(_messages(spark, 10, 10), root)
    assert _values(LogTopics(root).batch(spark, ["t"])) == list(range(20))
    assert TopicFiles(root).topics() == ["t"]


def test_messages_that_are_gone_are_an_error(spark):
    root = scratch_path(spark, "log")
    for start in (0, 10, 20):
        publish(_messages(spark, 10, start).coalesce(1), root, partitions=1)
    first = TopicFiles(root).segments("t", 0)[0][2]
    os.remove(local_path(first))  # retention took the oldest segment
    assert _values(LogTopics(root).batch(spark, ["t"])) == list(range(10, 30))  # the earliest that is kept
    with pytest.raises(Exception, match="not within"):
        LogTopics(root, json.dumps({"t": {"0": 3}})).batch(spark, ["t"]).count()

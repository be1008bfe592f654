"""The work on messages is dealt out however the events are stored, in few loads."""

import re

import pytest

from catalog import fixture, queries_io, stores


@pytest.fixture
def events_dir(spark, tmp_path):
    """1,000 events, in one row group of one file."""
    spark.range(1000).selectExpr(
        "id AS event_id", "timestampadd(MINUTE, cast(id % 900 * 40 AS int), TIMESTAMP_NTZ'2024-01-01 00:00:00') AS ts",
        "if(id % 50 = 7, null, id % 150) AS user_id", "if(id % 3 = 0, 'error', 'view') AS event_type",
        "if(id % 40 = 3, null, id * 0.37D) AS value", "if(id % 60 = 5, null, '{\"k\": 1}') AS props",
    ).coalesce(1).write.parquet(f"{tmp_path}/sf/events.parquet")
    return f"{tmp_path}/sf"


def test_messages_of_one_row_group_are_made_by_several_tasks(spark, events_dir, monkeypatch):
    monkeypatch.setattr(fixture, "ROWS_PER_TASK", 100)
    spread = fixture.load_raw_messages(spark, events_dir)
    whole = fixture.raw_messages(spark.read.parquet(f"{events_dir}/events.parquet"))
    sizes = [len(rows) for rows in spread.rdd.glom().collect()]
    assert len(sizes) == 10 and max(sizes) < 300
    assert sorted(map(str, spread.collect())) == sorted(map(str, whole.collect()))


def test_the_projection_has_no_method_that_the_jvm_leaves_uncompiled(spark, events_dir):
    raw = fixture.raw_messages(spark.read.parquet(f"{events_dir}/events.parquet"))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    methods = re.findall(r"maxMethodCodeSize:(\d+)", raw._jdf.queryExecution().explainString(mode))
    assert methods and max(map(int, methods)) < 8000


def test_many_files_are_taken_in_few_loads(spark, events_dir, monkeypatch):
    monkeypatch.setattr(fixture, "ROWS_PER_TASK", 50)
    done = []
    write = queries_io.LoadStore.write
    monkeypatch.setattr(queries_io.LoadStore, "write", lambda self, load, *a: (done.append(load), write(self, load, *a))[1])
    wh = stores.warehouse_for(spark, events_dir)
    assert len(wh.routed_frame(spark).inputFiles()) > 30
    store = queries_io._loaded(spark, events_dir)
    assert 2 <= len(set(done)) <= 4
    for name in ("kitchen", "dispatch", "dlq"):
        assert store.read(name).count() == getattr(wh.curated(spark), name).count() > 0

"""Every registered query against its DuckDB oracle on sf0.001, plus
whole-pipeline properties."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from catalog.queries import all_queries  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

SKIP = {"stream_route", "stream_raw", "stream_dispatch", "stream_dlq"}  # covered by test_streaming


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_small}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    spark_queries, sql = all_queries()
    assert set(spark_queries) == set(sql) and set(spark_queries) <= set(E.queries())


@pytest.mark.parametrize("name", [n for n in all_queries()[0] if n not in SKIP])
def test_query_matches_oracle(spark, sf_small, duck, name):
    df = E.queries()[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(rows) == len(d_rows)
    assert digest(df.columns, rows) == digest(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "station_id" and df.count() > 0


def test_pipeline_properties(spark, sf_small):
    from batchtrace.config import DLQ_OTHERS
    from batchtrace.config import Topics
    from catalog.fixture import load_raw_messages
    from catalog.stores import warehouse_for
    wh = warehouse_for(spark, sf_small)
    c = wh.curated(spark)
    raw = load_raw_messages(spark, sf_small)
    n_in = raw.filter(F.col("topic").isin(Topics().kitchen, Topics().dispatch)).count()
    assert n_in < raw.count()  # some are of a topic that nobody reads
    assert c.kitchen.count() + c.dispatch.count() + c.dlq.count() == n_in
    assert c.dlq.filter(F.col("error_reason") == DLQ_OTHERS).count() == 0
    assert c.dlq.filter(F.col("event_date").isNull()).count() == 16


def test_the_fixture_can_fail(spark, sf_small):
    """Hot batch, repeated visits, null ids, month edges: answers differ if these are mishandled."""
    from batchtrace.functions.period import Period
    from batchtrace.operators.graph import build_edges
    from batchtrace.operators.reports import batch_count
    from catalog.stores import warehouse_for
    c = warehouse_for(spark, sf_small).curated(spark)
    n = c.kitchen.count()
    assert build_edges(c.kitchen, c.dispatch).processed.count() < n
    month = Period.month("2024-01")
    assert 0 < c.kitchen.filter(month.contains("event_date")).count() < n
    assert c.kitchen.filter("batch_id IS NULL").count() > 1
    ids = {r.batch_id for r in c.kitchen.filter(month.contains("event_date")).collect()} | \
        {r.batch_id for r in c.dispatch.filter(month.contains("event_date")).collect()}
    assert None in ids and batch_count(c.kitchen, c.dispatch, month).first()[0] == len(ids)
    hot = c.kitchen.groupBy("batch_id").count().agg(F.max("count")).first()[0]
    assert hot > 0.05 * n


def test_a_rewritten_table_is_built_anew(spark, sf_small, tmp_path):
    import shutil
    from catalog.stores import warehouse_for
    shutil.copyfile(f"{sf_small}/events.parquet", tmp_path / "events.parquet")
    first = warehouse_for(spark, str(tmp_path))
    assert warehouse_for(spark, str(tmp_path)) is first
    spark.read.parquet(f"{sf_small}/events.parquet").limit(60).coalesce(1).write.parquet(str(tmp_path / "new"))
    shutil.copyfile(next((tmp_path / "new").glob("part-*.parquet")), tmp_path / "events.parquet")
    again = warehouse_for(spark, str(tmp_path))
    assert again is not first and again.routed_frame(spark).count() <= 60

"""Stored tables of the driver's ``events``, built once and reused by the queries.

The key holds the input's path, size and modification time, so a table that is
rewritten in the same application is built anew. Each key has its own lock.
"""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql import SparkSession

from batchtrace import config as C
from batchtrace.operators.graph import Edges
from batchtrace.plans.curated import Curated
from batchtrace.plans.warehouse import Warehouse, build, build_graph
from batchtrace.session import app_id, scratch_path
from catalog.fixture import load_raw_messages

#: Days of a graph part: a week of these small tables.
HOME_DAYS = 7
_BUILT: dict[tuple, Warehouse] = {}
_GRAPHS: set[str] = set()
_LOCKS: defaultdict[object, threading.Lock] = defaultdict(threading.Lock)


def _state(spark: SparkSession, path: str) -> tuple[int, int]:
    """Total size and latest modification time of a file or folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = fs.listStatus(p)
    return sum(f.getLen() for f in files), max(f.getModificationTime() for f in files)


def warehouse_for(spark: SparkSession, sf_dir: str, thresholds: C.Thresholds = C.Thresholds(),
                  topics: C.Topics = C.Topics()) -> Warehouse:
    key = (app_id(spark), sf_dir.rstrip("/"), _state(spark, f"{sf_dir.rstrip('/')}/events.parquet"), thresholds, topics)
    with _LOCKS[key]:
        if key not in _BUILT:
            root = scratch_path(spark, "warehouse")
            _BUILT[key] = build(spark, load_raw_messages(spark, sf_dir), root, thresholds, topics, HOME_DAYS)
        return _BUILT[key]


def curated_for(spark: SparkSession, sf_dir: str) -> Curated:
    return warehouse_for(spark, sf_dir).curated(spark)


def graph_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    wh = warehouse_for(spark, sf_dir)
    with _LOCKS[wh.root]:
        if wh.root not in _GRAPHS:
            build_graph(spark, wh)
            _GRAPHS.add(wh.root)
    return wh


def graph_for(spark: SparkSession, sf_dir: str) -> Edges:
    """Stored graph edges for ``sf_dir`` (loaded once per application)."""
    return graph_warehouse(spark, sf_dir).graph_edges(spark)

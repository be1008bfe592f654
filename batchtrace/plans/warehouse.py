"""Stored form of the pipeline: routed messages and curated tables.

``build`` runs the batch form of the ingest pipeline once and writes

* ``routed``     – every subscribed message with ``is_valid``, partitioned by ``route``
* ``raw_kitchen``, ``raw_dispatch`` – raw archives of the clean topics (S4)
* ``kitchen``, ``dispatch`` – curated rows, partitioned by ``event_date``, sorted by
  batch id with Bloom filters on it (S5)
* ``dlq``        – classified dead letters, partitioned by payload date (S6)
* ``batch_dates`` – the key -> dates index of the curated tables, sorted by batch id
* ``rollup_*``   – per-day partial aggregates of the period reports, sorted by date

Each step reads the previous step's files, so every plan is small, each JSON
parse happens once per message, and a lost executor only recomputes its own
tasks from stored input. Reports then read the curated tables with a filter on
``event_date`` that prunes partitions. Every stored table is declared in the
session's catalog when it is written (or first read), so reads list no files.

The folder lives under the session's shared checkpoint folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchtrace import config as C
from batchtrace import schemas
from batchtrace.operators.dlq import classify_dlq
from batchtrace.operators.ingest import decode_raw, route
from batchtrace.operators.graph import Edges
from batchtrace.session import at_once
from batchtrace.plans.curated import Curated, dispatch_from_clean, kitchen_from_clean
from batchtrace.operators.journey import batch_dates
from batchtrace.plans.graph_store import GraphStore
from batchtrace.plans.rollups import PARTIAL_TABLES, partials
from batchtrace.sinks import catalog
from batchtrace.sinks.files import write_lookup_table, write_table


@dataclass(frozen=True)
class Warehouse:
    """Folders of the stored tables. ``home_days`` is the span of a graph part (see ``plans.graph_store``)."""

    root: str
    home_days: int = 1

    @property
    def routed(self) -> str:
        return f"{self.root}/routed"

    @property
    def raw_kitchen(self) -> str:
        return f"{self.root}/raw_kitchen"

    @property
    def raw_dispatch(self) -> str:
        return f"{self.root}/raw_dispatch"

    @property
    def kitchen(self) -> str:
        return f"{self.root}/kitchen"

    @property
    def dispatch(self) -> str:
        return f"{self.root}/dispatch"

    @property
    def dlq(self) -> str:
        return f"{self.root}/dlq"

    @property
    def batch_dates(self) -> str:
        return f"{self.root}/batch_dates"

    def rollup(self, name: str) -> str:
        return f"{self.root}/rollup_{name}"

    def _stored(self, spark: SparkSession, path: str) -> DataFrame:
        """A table by its declaration in the catalog, made on first use."""
        schema, partition_by = _LAYOUT[path.rsplit("/", 1)[-1]]
        name = catalog.table_name(path, path.rsplit("/", 1)[-1])
        if not catalog.declared(spark, name):
            catalog.recover(spark, name, schema, path, partition_by)
        return catalog.read(spark, name)

    def refresh(self, spark: SparkSession) -> Warehouse:
        """Declare all tables anew, after another session has written them."""
        for name in _LAYOUT:
            catalog.forget(spark, catalog.table_name(f"{self.root}/{name}", name))
        return self

    def routed_frame(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark, self.routed)

    def curated(self, spark: SparkSession) -> Curated:
        return Curated(kitchen=self._stored(spark, self.kitchen), dispatch=self._stored(spark, self.dispatch),
                       dlq=self._stored(spark, self.dlq))

    def batch_index(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark, self.batch_dates)

    def rollups(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: self._stored(spark, self.rollup(name)) for name in PARTIAL_TABLES}

    @property
    def graph(self) -> str:
        return f"{self.root}/graph"

    def graph_store(self, spark: SparkSession) -> GraphStore:
        return GraphStore(spark, self.graph, self.home_days)

    def graph_edges(self, spark: SparkSession) -> Edges:
        return self.graph_store(spark).edges()

    def graph_nodes(self, spark: SparkSession) -> DataFrame:
        return self.graph_store(spark).nodes()

    def raw_archive(self, spark: SparkSession, which: str) -> DataFrame:
        return self._stored(spark, self.raw_kitchen if which == "kitchen" else self.raw_dispatch)


#: Stored tables: columns and partition columns.
_LAYOUT = {
    "routed": (schemas.ROUTED, ("route",)),
    "raw_kitchen": (schemas.RAW_ARCHIVE, ()),
    "raw_dispatch": (schemas.RAW_ARCHIVE, ()),
    "kitchen": (schemas.KITCHEN_CURATED, ("event_date",)),
    "dispatch": (schemas.DISPATCH_CURATED, ("event_date",)),
    "dlq": (schemas.DLQ_CLASSIFIED, ("event_date",)),
    "batch_dates": (schemas.BATCH_DATES, ()),
} | {f"rollup_{name}": (schema, ()) for name, schema in PARTIAL_TABLES.items()}


def build(spark: SparkSession, raw: DataFrame, root: str,
          thresholds: C.Thresholds = C.Thresholds(), topics: C.Topics = C.Topics(), home_days: int = 1) -> Warehouse:
    wh = Warehouse(root, home_days).refresh(spark)
    # Router: one parse per message; the route becomes a directory.
    write_table(route(raw, topics), wh.routed, ("route",), mode="overwrite")
    routed = wh.routed_frame(spark)
    r = F.col("route")
    clean_k = routed.filter(r == C.ROUTE_CLEAN_KITCHEN)
    clean_d = routed.filter(r == C.ROUTE_CLEAN_DISPATCH)
    dead = routed.filter(r == C.ROUTE_DLQ)
    # Raw archives and curated tables of the clean topics.
    curated_k = kitchen_from_clean(clean_k, thresholds).select(*schemas.KITCHEN_CURATED.fieldNames())
    curated_d = dispatch_from_clean(clean_d, thresholds).select(*schemas.DISPATCH_CURATED.fieldNames())
    letters = classify_dlq(decode_raw(dead)).select(*schemas.DLQ_CLASSIFIED.fieldNames())
    at_once([
        lambda: write_table(decode_raw(clean_k), wh.raw_kitchen, mode="overwrite"),
        lambda: write_table(decode_raw(clean_d), wh.raw_dispatch, mode="overwrite"),
        lambda: write_lookup_table(curated_k, wh.kitchen, "batch_id", ("event_date",), mode="overwrite"),
        lambda: write_lookup_table(curated_d, wh.dispatch, "batch_id", ("event_date",), mode="overwrite"),
        lambda: write_lookup_table(letters, wh.dlq, "batch_id", ("event_date",), mode="overwrite"),
    ])
    # What is derived from the stored curated tables.
    c = wh.curated(spark)
    derived = {wh.rollup(name): (df, "event_date") for name, df in partials(c.kitchen, c.dispatch, c.dlq).items()}
    derived[wh.batch_dates] = (batch_dates(c.kitchen, c.dispatch), "batch_id")
    at_once([lambda p=path, d=df, k=key: write_lookup_table(d, p, k, mode="overwrite") for path, (df, key) in derived.items()])
    return wh


def build_graph(spark: SparkSession, wh: Warehouse) -> Warehouse:
    """Load the graph tables (S10) from the stored curated tables, replacing what is stored."""
    c = wh.curated(spark)
    wh.graph_store(spark).build(c.kitchen, c.dispatch)
    return wh


def merge_graph(spark: SparkSession, wh: Warehouse, kitchen: DataFrame, dispatch: DataFrame) -> Warehouse:
    """Merge new curated rows into the stored graph (G4): only the parts that hold
    batches of these rows are read and rewritten, all switched at once."""
    wh.graph_store(spark).merge(kitchen, dispatch)
    return wh

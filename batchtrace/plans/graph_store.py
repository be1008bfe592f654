"""The traceability graph as stored tables that are merged part by part.

All edges of a batch lie in the batch's *home* part, named after the first day (or
the first day of a span of ``home_days`` days) that the batch was seen on when it was
first stored; batches live for hours, so a load touches the homes of its own days and
few others. The tables are bucketed by batch id. Stored beside the edges:

* ``batches``  – every batch with its home, the key -> part index of merges;
* ``days``     – the homes that hold events of a day, the day -> part index of queries;
* ``nodes``    – nodes of the other labels, a part a label.

``merge`` places the load's batches (known ones in their homes), reads and rewrites
only the parts of these homes, and switches them all at once; other parts keep their
files. Path queries ask ``days`` for the homes of their day and scan these parts of
every edge table only; their joins on batch id need no shuffle of the edges.

Rows with a null key are skipped, as everywhere in the graph; batches without any
dated event live in the part ``undated``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from batchtrace import schemas
from batchtrace.functions.period import Period
from batchtrace.operators import graph as G
from batchtrace.session import scratch_path
from batchtrace.sinks.parts import Frame, PartStore, PartTable

UNDATED, ALL = "undated", "all"
#: Relation -> the end that is a batch; ``requires`` has none.
BATCH_END = {"processed": "dst", "uses_recipe": "src", "delivers": "dst", "destined_for": "src"}

_TABLES = (
    PartTable("processed", schemas.PROCESSED_EDGES, "home", "dst"),
    PartTable("uses_recipe", schemas.PLAIN_EDGES, "home", "src"),
    PartTable("delivers", schemas.DELIVERS_EDGES, "home", "dst"),
    PartTable("destined_for", schemas.PLAIN_EDGES, "home", "src"),
    PartTable("batches", StructType([StructField("batch_id", StringType())]), "home", "batch_id"),
    PartTable("requires", schemas.PLAIN_EDGES, "home"),
    PartTable("days", StructType([StructField("event_day", DateType()), StructField("batch_home", StringType())]), "home"),
    PartTable("nodes", StructType([StructField("id", StringType())]), "label"),
)


@dataclass
class StoredEdges(G.Edges):
    """Stored edges; ``of_day`` prunes every keyed relation to the day's homes."""

    store: GraphStore | None = None

    def of_day(self, day: Period) -> G.Edges:
        return self.store.edges(self.store.homes_of(day))


class GraphStore:
    def __init__(self, spark: SparkSession, root: str, home_days: int = 1, buckets: int | None = None):
        """``home_days`` and ``buckets`` hold from the first write on; buckets default to the session's shuffle partitions."""
        self.spark, self.home_days = spark, home_days
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.parts = PartStore(spark, root, _TABLES, buckets)

    # --- reading --------------------------------------------------------------

    def edges(self, homes: list[str] | None = None) -> StoredEdges:
        """All edges, or those of the given homes."""
        def of(name: str) -> DataFrame:
            df = self.parts.read(name)
            if homes is not None and name in BATCH_END:
                df = df.filter(F.col("home").isin(homes))
            return df.drop("home")
        return StoredEdges(**{name: of(name) for name in ("processed", "uses_recipe", "requires", "delivers", "destined_for")},
                           store=self)

    def nodes(self) -> DataFrame:
        batches = self.parts.read("batches").select(F.lit("Batch").alias("label"), F.col("batch_id").alias("id"))
        return batches.unionByName(self.parts.read("nodes").select("label", "id"))

    def homes_of(self, day: Period) -> list[str]:
        """Homes with events of the day (at most one a stored day)."""
        rows = self.parts.read("days").filter(day.contains("event_day")).select("batch_home").distinct().collect()
        return sorted(r["batch_home"] for r in rows)

    # --- writing --------------------------------------------------------------

    def _home(self, day: Column) -> Column:
        first = F.date_sub(day, F.pmod(F.datediff(day, F.lit("1970-01-01").cast("date")), F.lit(self.home_days))) \
            if self.home_days > 1 else day
        return F.coalesce(first.cast("string"), F.lit(UNDATED))

    def _placed(self, k: DataFrame, d: DataFrame, merging: bool) -> DataFrame:
        """``batch_id, home, is_new, in_k, in_d`` of the load's batches, stored for the steps that follow."""
        seen = [df.select("batch_id", "event_date", F.lit(i == 0).alias("in_k"), F.lit(i == 1).alias("in_d")) for i, df in enumerate((k, d))]
        own = seen[0].unionAll(seen[1]).filter(F.col("batch_id").isNotNull()).groupBy("batch_id") \
            .agg(F.min("event_date").alias("first"), F.max("in_k").alias("in_k"), F.max("in_d").alias("in_d")) \
            .withColumn("own", self._home(F.col("first")))
        if merging:
            known = self.parts.read("batches").withColumnRenamed("home", "known")
            own = own.join(known, "batch_id", "left")
        else:
            own = own.withColumn("known", F.lit(None).cast("string"))
        placed = own.select("batch_id", F.coalesce("known", "own").alias("home"), F.col("known").isNull().alias("is_new"), "in_k", "in_d")
        path = scratch_path(self.spark, "placed")
        placed.write.parquet(path)
        return self.spark.read.schema(placed.schema).parquet(path)

    def build(self, k: DataFrame, d: DataFrame) -> GraphStore:
        """Replace all that is stored by the graph of these rows."""
        return self._load(k, d, merging=False)

    def merge(self, k: DataFrame, d: DataFrame) -> GraphStore:
        """Merge new curated rows into what is stored; the same rows again change nothing."""
        return self._load(k, d, merging=self.parts.current() is not None)

    def _load(self, k: DataFrame, d: DataFrame, merging: bool) -> GraphStore:
        placed = self._placed(k, d, merging)
        marks = ("in_k", "in_d", "is_new")
        touched = placed.groupBy("home").agg(*[F.max(m).alias(m) for m in marks]).collect() if merging else []  # one row a day
        homes = {m: [r["home"] for r in touched if r[m]] for m in marks}
        new = G.build_edges(k, d)
        frames: dict[str, Frame] = {}
        for rel, end in BATCH_END.items():
            load = getattr(new, rel).join(placed.select(F.col("batch_id").alias(end), "home"), end)
            if merging:
                stored = self.parts.read(rel).filter(F.col("home").isin(homes["in_k" if rel in ("processed", "uses_recipe") else "in_d"]))
                load = _reduced(stored.unionByName(load.select(*stored.columns)), rel)
            frames[rel] = load
        batches = placed.filter("is_new").select("batch_id", "home")
        if merging:
            batches = self.parts.read("batches").filter(F.col("home").isin(homes["is_new"])).unionByName(batches)
        frames["batches"] = batches
        frames |= self._small(k, d, new, placed, merging)
        self.parts.replace(frames, whole=not merging)
        return self

    def _small(self, k: DataFrame, d: DataFrame, new: G.Edges, placed: DataFrame, merging: bool) -> dict[str, Frame]:
        """``requires``, ``days`` and ``nodes``: rewritten (per label) only if the load adds to them."""
        # homes of the days of every edge that a day can ask for
        days = new.processed.select(F.col("dst").alias("batch_id"), "event_day").join(placed, "batch_id") \
            .select("event_day", F.col("home").alias("batch_home")).distinct().withColumn("home", F.lit(ALL))
        requires = new.requires.withColumn("home", F.lit(ALL))
        nodes = G.build_nodes(k, d).filter(F.col("label") != "Batch").select("id", "label")
        if not merging:
            return {"days": days, "requires": requires, "nodes": nodes}
        def grown(name: str, frame: DataFrame) -> DataFrame | None:
            stored = self.parts.read(name)
            added = frame.select(*stored.columns).exceptAll(stored).distinct()
            return None if added.isEmpty() else stored.unionByName(added)

        def grown_nodes() -> DataFrame | None:
            stored = self.parts.read("nodes")
            added = nodes.join(stored, ["label", "id"], "left_anti")
            labels = [r["label"] for r in added.select("label").distinct().collect()]  # five at most
            return stored.filter(F.col("label").isin(labels)).unionByName(added) if labels else None

        return {"days": lambda: grown("days", days), "requires": lambda: grown("requires", requires), "nodes": grown_nodes}


def _reduced(rows: DataFrame, rel: str) -> DataFrame:
    """One row per edge of stored and new ones, in the edge's home."""
    if rel in ("processed", "delivers"):
        props = G.PROCESSED_PROPS if rel == "processed" else G.DELIVERS_PROPS
        return G.latest(rows, props, "home")
    return rows.distinct()

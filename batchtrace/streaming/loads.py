"""The ingest tables from one stream: numbered loads, committed whole, compacted by date.

One query reads the router's output once; every micro-batch is a load with the
query's batch number. ``LoadStore.write`` puts each table of the load into a folder
of its own, then what is derived from them (the key -> dates index and the per-day
partials, computed from the files just written), and at last one small commit file.
Readers take committed loads only, so all tables of a load appear together. A load
that is repeated after a failure skips the tables that were finished (Spark's
``_SUCCESS`` marker), writes the others anew, and does nothing if it was committed.

``compact`` takes the loads committed since the last time. For a table stored by
date it rewrites the dates that these loads touched, old compacted rows and new ones
together, as lookup files; other dates keep their files. Tables without dates get
one more compacted folder. A manifest, switched atomically, says which folders hold
the compacted form and up to which load: readers see a row in one form only.
``clean`` removes what no retained manifest needs.

Folders of a table: ``load=<n>`` and ``load=c-<id>``, each with ``event_date=…`` below
for tables stored by date.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from batchtrace import config as C
from batchtrace import schemas
from batchtrace.operators.dlq import classify_dlq
from batchtrace.operators.ingest import decode_raw
from batchtrace.operators.journey import batch_dates
from batchtrace.plans.curated import Curated, dispatch_from_clean, kitchen_from_clean
from batchtrace.plans.rollups import PARTIAL_TABLES, partials
from batchtrace.session import at_once
from batchtrace.sinks.files import write_lookup_table
from batchtrace.sinks.versions import Files, VersionedFolder
from batchtrace.streaming.pipeline import _apply_trigger

MANIFEST = "manifest.json"


@dataclass(frozen=True)
class LoadTable:
    """``key`` orders the compacted files; ``by_date`` tables are stored by ``event_date``."""

    schema: StructType
    key: str
    by_date: bool = False

    @property
    def parts(self) -> tuple[str, ...]:
        return ("event_date",) if self.by_date else ()


TABLES = {
    "raw_kitchen": LoadTable(schemas.RAW_ARCHIVE, "event_timestamp"),
    "raw_dispatch": LoadTable(schemas.RAW_ARCHIVE, "event_timestamp"),
    "kitchen": LoadTable(schemas.KITCHEN_CURATED, "batch_id", True),
    "dispatch": LoadTable(schemas.DISPATCH_CURATED, "batch_id", True),
    "dlq": LoadTable(schemas.DLQ_CLASSIFIED, "batch_id", True),
}
DERIVED = {"batch_dates": LoadTable(schemas.BATCH_DATES, "batch_id")} | {
    f"rollup_{name}": LoadTable(schema, "event_date") for name, schema in PARTIAL_TABLES.items()}


class LoadStore:
    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, LoadTable] = TABLES | DERIVED):
        self.spark, self.files, self.tables = spark, Files(spark, root), dict(tables)
        self.root = self.files.root
        self.manifests = VersionedFolder(spark, f"{self.root}/_compacted")
        self._read: dict[str, tuple[tuple, DataFrame]] = {}

    # --- commits --------------------------------------------------------------

    def manifest(self) -> dict:
        """The last compacted load, and per table its compacted folders: by date folder, or a list."""
        current = self.manifests.current()
        if current is None:
            return {"through": -1, "tables": {}}
        return json.loads(self.manifests.files.read(f"{current.rsplit('/', 1)[-1]}/{MANIFEST}"))

    def loads(self) -> list[int]:
        """Numbers of the committed loads that are not compacted."""
        through = self.manifest()["through"]
        numbers = (int(n.removesuffix(".json")) for n in self.files.names("_commits"))
        return sorted(n for n in numbers if n > through)

    def committed(self, load: int) -> bool:
        return load <= self.manifest()["through"] or self.files.exists(f"_commits/{load}.json")

    def _touched(self, load: int) -> dict[str, list[str]]:
        return json.loads(self.files.read(f"_commits/{load}.json"))

    def write(self, load: int, frames: Mapping[str, DataFrame],
              derive: Callable[[dict[str, DataFrame]], Mapping[str, DataFrame]] | None = None) -> bool:
        """Add a load; ``derive`` makes further tables of the stored ones. False if it was there already."""
        if self.committed(load):
            return False
        self._write_tables(load, frames)
        names = list(frames)
        if derive is not None:
            own = {n: self._frame(n, [f"{self.root}/{n}/load={load}"]) for n in names}
            more = derive(own)
            self._write_tables(load, more)
            names += list(more)
        touched = {n: sorted(self.files.folders(f"{n}/load={load}")) if self.tables[n].by_date else [] for n in names}
        self.files.write(f"_commits/{load}.json", json.dumps(touched))
        return True

    def _write_tables(self, load: int, frames: Mapping[str, DataFrame]) -> None:
        def put(name: str, df: DataFrame) -> None:
            folder = f"{name}/load={load}"
            if not self.files.exists(f"{folder}/_SUCCESS"):
                table = self.tables[name]
                df.select(*table.schema.fieldNames()).write.mode("overwrite").partitionBy(*table.parts).parquet(f"{self.root}/{folder}")
        at_once([lambda n=n, df=df: put(n, df) for n, df in frames.items()])

    # --- reading --------------------------------------------------------------

    def _frame(self, name: str, folders: list[str]) -> DataFrame:
        schema = StructType([*self.tables[name].schema.fields, StructField("load", StringType())])
        if not folders:
            return self.spark.createDataFrame([], self.tables[name].schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*folders).drop("load")

    def read(self, name: str) -> DataFrame:
        """All committed rows of a table; listed once for each state of the store."""
        manifest, loads = self.manifest(), self.loads()
        held = manifest["tables"].get(name, {} if self.tables[name].by_date else [])
        state = (manifest["through"], self.manifests.current(), tuple(loads))
        if name not in self._read or self._read[name][0] != state:
            folders = list(held.values()) if isinstance(held, dict) else list(held)
            folders += [f"load={n}" for n in loads if name in self._touched(n)]
            self._read[name] = (state, self._frame(name, [f"{self.root}/{name}/{f}" for f in folders]))
        return self._read[name][1]

    def curated(self) -> Curated:
        return Curated(kitchen=self.read("kitchen"), dispatch=self.read("dispatch"), dlq=self.read("dlq"))

    def rollups(self) -> dict[str, DataFrame]:
        return {name: self.read(f"rollup_{name}") for name in PARTIAL_TABLES}

    # --- compaction -----------------------------------------------------------

    def compact(self) -> list[int]:
        """Compact the loads committed since the last time; returns their numbers."""
        before, loads = self.manifest(), self.loads()
        if not loads:
            return []
        touched = {n: self._touched(n) for n in loads}
        piece = f"load=c-{uuid.uuid4().hex[:12]}"

        def table(name: str) -> tuple[str, dict[str, str] | list[str]]:
            spec = self.tables[name]
            new = [f"load={n}" for n in loads if name in touched[n]]
            held = before["tables"].get(name, {} if spec.by_date else [])
            if not new:
                return name, held
            dates = {d for n in loads for d in touched[n].get(name, [])}
            rewritten = [held[d] for d in sorted(dates & set(held))] if spec.by_date else []
            rows = self._frame(name, [f"{self.root}/{name}/{f}" for f in rewritten + new])
            write_lookup_table(rows, f"{self.root}/{name}/{piece}", spec.key, spec.parts, mode="overwrite")
            if not spec.by_date:
                return name, [*held, piece]
            return name, held | {d: f"{piece}/{d}" for d in dates}

        tables = dict(at_once([lambda n=n: table(n) for n in self.tables]))
        text = json.dumps({"through": loads[-1], "tables": tables})
        self.manifests.replace(lambda folder: self.manifests.files.write(f"{folder.rsplit('/', 1)[-1]}/{MANIFEST}", text))
        return loads

    def clean(self, keep: int = 1, younger_than: float = 86_400.0) -> list[str]:
        """Remove loads and compacted folders that no retained manifest, nor the
        loads after the oldest of these, need. Readers that started on one
        retained keep their files."""
        history = self.manifests.retained(keep, younger_than)
        kept = [json.loads(self.manifests.files.read(f"{v.name}/{MANIFEST}")) for v in history]
        if not kept:
            return []
        through = min(m["through"] for m in kept)
        gone = []
        for name, spec in self.tables.items():
            held = {f for m in kept for f in (m["tables"].get(name) or {})} if not spec.by_date else \
                {f for m in kept for f in m["tables"].get(name, {}).values()}
            for folder, at in self.files.folders(name).items():
                number = folder.removeprefix("load=")
                if number.isdigit():
                    if int(number) <= through:
                        gone.append(f"{name}/{folder}")
                elif spec.by_date and any(f.startswith(f"{folder}/") for f in held):
                    gone += [f for d in self.files.folders(f"{name}/{folder}")
                             if (f := f"{name}/{folder}/{d}").removeprefix(f"{name}/") not in held]
                elif folder not in held and at < self.manifests.oldest(younger_than):
                    gone.append(f"{name}/{folder}")
        self.manifests.clean(keep, younger_than)
        done = [n for n in self.files.names("_commits") if int(n.removesuffix(".json")) <= through]
        for folder in [*gone, *(f"_commits/{n}" for n in done)]:
            self.files.remove(folder)
        return sorted(gone)


def load_frames(routed: DataFrame, thresholds: C.Thresholds = C.Thresholds()) -> dict[str, DataFrame]:
    """The five ingest tables of routed messages."""
    r = F.col("route")
    clean_k, clean_d = routed.filter(r == C.ROUTE_CLEAN_KITCHEN), routed.filter(r == C.ROUTE_CLEAN_DISPATCH)
    return {
        "raw_kitchen": decode_raw(clean_k), "kitchen": kitchen_from_clean(clean_k, thresholds),
        "raw_dispatch": decode_raw(clean_d), "dispatch": dispatch_from_clean(clean_d, thresholds),
        "dlq": classify_dlq(decode_raw(routed.filter(r == C.ROUTE_DLQ))),
    }


def derived_frames(stored: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The key -> dates index and the per-day partials of a load's curated rows."""
    k, d = stored["kitchen"], stored["dispatch"]
    return {"batch_dates": batch_dates(k, d)} | {f"rollup_{n}": df for n, df in partials(k, d, stored["dlq"]).items()}


def start_loads(spark: SparkSession, source, store: LoadStore, checkpoint: str, thresholds: C.Thresholds = C.Thresholds(),
                trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """One query that feeds all tables (T1); ``source`` has ``stream_routes``."""
    def each(batch: DataFrame, number: int) -> None:
        store.write(number, load_frames(batch, thresholds), derived_frames)

    w = source.stream_routes(spark).writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    return _apply_trigger(w.queryName(name) if name else w, trigger).start()

"""Tables that are made of parts, each replaced on its own, all switched together.

A store holds several tables. A table is cut into parts by one text column; a
manifest says in which folder each part of each table lies now. A write fills a new
version folder with the parts it touches, and with a manifest that takes all other
parts from the version before: untouched parts keep their files, and one atomic
switch of the version makes the new parts of all tables visible at once. So a small
change costs what it touches, readers see all of it or nothing, and a failed writer
leaves nothing behind but an unused folder.

Parts are written bucketed by the table's key. Reads go through the catalog, where
each part is a partition with the location from the manifest: filters on the part
column prune, and joins on the key need no shuffle of the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from batchtrace.session import at_once
from batchtrace.sinks import catalog
from batchtrace.sinks.versions import VersionedFolder

MANIFEST = "manifest.json"
#: A table's new parts, or what makes them.
Frame = DataFrame | Callable[[], DataFrame | None]


@dataclass(frozen=True)
class PartTable:
    """``schema`` without the part column, which is text of letters, digits, dots and dashes."""

    name: str
    schema: StructType
    part: str
    key: str | None = None

    @property
    def stored(self) -> StructType:
        return StructType([*self.schema.fields, StructField(self.part, StringType())])


class PartStore:
    def __init__(self, spark: SparkSession, root: str, tables: tuple[PartTable, ...], buckets: int):
        self.spark, self.versions = spark, VersionedFolder(spark, root)
        self.root = self.versions.root
        self.tables = {t.name: t for t in tables}
        self.buckets = buckets

    # --- what is stored -------------------------------------------------------

    def _manifest(self, version: str | None) -> dict:
        """Buckets, and per table its parts' folders relative to the store."""
        if version is None:
            return {"buckets": self.buckets, "parts": {name: {} for name in self.tables}}
        text = self.versions.files.read(f"{version.rsplit('/', 1)[-1]}/{MANIFEST}")
        return json.loads(text)

    def current(self) -> str | None:
        return self.versions.current()

    def parts(self, table: str) -> dict[str, str]:
        """Part -> folder of the current version."""
        return {p: f"{self.root}/{folder}" for p, folder in self._manifest(self.current())["parts"].get(table, {}).items()}

    def read(self, table: str) -> DataFrame:
        """The table as the current version has it."""
        version, spec = self.current(), self.tables[table]
        if version is None:
            raise FileNotFoundError(f"nothing is stored under {self.root}")
        name = catalog.table_name(self.root, version, table)
        if not catalog.declared(self.spark, name):
            manifest = self._manifest(version)
            catalog.declare(self.spark, name, spec.stored, f"{self.root}/_unused", (spec.part,), spec.key, manifest["buckets"])
            folders = manifest["parts"].get(table, {})
            catalog.add_parts(self.spark, name, spec.part, {p: f"{self.root}/{f}" for p, f in folders.items()})
        return catalog.read(self.spark, name)

    # --- changes --------------------------------------------------------------

    def replace(self, frames: Mapping[str, Frame], whole: bool = False) -> str:
        """Replace the parts that the frames hold; ``whole`` drops all others.

        A frame has its table's columns and the part column, and holds all rows of
        every part that it holds any of. It may be given as a function that makes
        it, or None if nothing changes; tables are made and written side by side.
        """
        before = self._manifest(None if whole else self.current())
        buckets = before["buckets"]

        def write(folder: str) -> None:
            version = folder.rsplit("/", 1)[-1]
            parts = {name: dict(before["parts"].get(name, {})) for name in self.tables}
            def put(name: str, frame: Frame) -> None:
                made = frame() if callable(frame) else frame
                if made is not None:
                    self._write(self.tables[name], made, f"{folder}/{name}", buckets)

            at_once([lambda n=n, f=f: put(n, f) for n, f in frames.items()])
            for name in frames:
                column = self.tables[name].part
                for part in self.versions.files.folders(f"{version}/{name}"):
                    if part.startswith(f"{column}="):
                        parts[name][part.removeprefix(f"{column}=")] = f"{version}/{name}/{part}"
            self.versions.files.write(f"{version}/{MANIFEST}", json.dumps({"buckets": buckets, "parts": parts}))

        return self.versions.replace(write)

    def _write(self, spec: PartTable, frame: DataFrame, folder: str, buckets: int) -> None:
        columns = frame.select(*spec.stored.fieldNames())
        if spec.key is None:
            columns.repartition(spec.part).write.partitionBy(spec.part).parquet(folder)
            return
        name = f"bt_writing_{uuid.uuid4().hex[:12]}"
        catalog.declare(self.spark, name, spec.stored, folder, (spec.part,), spec.key, buckets)
        try:  # a task holds one bucket of every part: few files, whatever the rows of a part
            columns.repartition(buckets, spec.key).write.insertInto(name)
        finally:
            catalog.forget(self.spark, name)

    def clean(self, keep: int = 3, younger_than: float = 86_400.0) -> list[str]:
        """Remove the folders of parts that no retained version holds; see ``VersionedFolder.clean``."""
        seen, history = self.versions.history(), self.versions.retained(keep, younger_than)
        kept = {v.name for v in history}
        held = {f for v in kept for parts in self._manifest(v)["parts"].values() for f in parts.values()}
        users = {f.split("/", 1)[0] for f in held}
        if history != seen:
            self.versions._switch(seen, history)
        files, oldest = self.versions.files, self.versions.oldest(younger_than)
        gone = [v for v, at in files.folders().items() if v.startswith("v-") and v not in kept | users and at < oldest]
        for version in sorted(v for v in users - kept if files.exists(v)):  # an old version with some parts still in use
            for table in files.folders(version):
                every = [f"{version}/{table}/{part}" for part in files.folders(f"{version}/{table}")]
                gone += [f for f in every if f not in held]
        for version in {v.name for v in seen} - kept:
            for table in self.tables:
                catalog.forget(self.spark, catalog.table_name(self.root, f"{self.root}/{version}", table))
        for folder in gone:
            files.remove(folder)
        return sorted(gone)

"""A folder whose contents are replaced as a whole, with a history of versions.

Writers fill a new version folder and then switch a small pointer file by an
atomic rename, so readers see the old contents or the new, never a part, and a
failed writer leaves the old contents in place. Works on any Hadoop file system
whose rename replaces a file.

The pointer file holds the history: one entry (name, time) a switch, the last of
them current. ``roll_back`` makes an earlier version current again (as a switch of
its own), ``clean`` removes versions by number and age. A version that is still
current, kept, or younger than the given age is never removed, so readers that
opened one lately keep it; choose an age above the longest query.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

POINTER = "CURRENT"


class ConcurrentWrite(RuntimeError):
    """Another writer has switched the folder meanwhile; nothing was changed."""


class Files:
    """Small driver-side file operations on the store that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        sc = spark.sparkContext
        self._gateway, self._hadoop = sc._gateway, sc._jvm.org.apache.hadoop.fs
        folder = self._hadoop.Path(self.root)
        conf = sc._jsc.hadoopConfiguration()
        self._fs = folder.getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(self._fs.makeQualified(folder).toUri(), conf)
        self._rename = getattr(self._hadoop, "Options$Rename")

    def path(self, name: str):
        return self._hadoop.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def read(self, name: str) -> str | None:
        """The text of a file; None if there is none."""
        if not self.exists(name):
            return None
        stream = self._fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file appears whole, replacing an older one, or not at all."""
        folder, _, file = name.rpartition("/")
        temporary = self.path(f"{folder}/_{file}-{uuid.uuid4().hex[:12]}")
        stream = self._fs.create(temporary)
        stream.write(bytearray(text.encode()))
        stream.close()
        replacing = self._gateway.new_array(self._rename, 1)
        replacing[0] = self._rename.OVERWRITE
        self._context.rename(temporary, self.path(name), replacing)

    def folders(self, name: str = "") -> dict[str, float]:
        """Names and modification times (epoch seconds) of the folders in a folder."""
        if not self.exists(name):
            return {}
        return {f.getPath().getName(): f.getModificationTime() / 1000 for f in self._fs.listStatus(self.path(name)) if f.isDirectory()}

    def names(self, name: str = "") -> list[str]:
        """Names of the files in a folder, hidden ones apart."""
        if not self.exists(name):
            return []
        every = [f.getPath().getName() for f in self._fs.listStatus(self.path(name)) if f.isFile()]
        return [n for n in every if not n.startswith(("_", "."))]

    def remove(self, name: str) -> None:
        self._fs.delete(self.path(name), True)

    def swap(self, new: str, name: str) -> None:
        """Put a finished folder in the place of another, which is removed afterwards."""
        old = f"_old-{uuid.uuid4().hex[:12]}"
        if self.exists(name) and not self._fs.rename(self.path(name), self.path(old)):
            raise OSError(f"{self.root}/{name} cannot be moved")
        if not self._fs.rename(self.path(new), self.path(name)):
            self._fs.rename(self.path(old), self.path(name))
            raise OSError(f"{self.root}/{new} cannot be moved to {name}")
        self.remove(old)


@dataclass(frozen=True)
class Version:
    name: str
    at: float


class VersionedFolder:
    def __init__(self, spark: SparkSession, root: str):
        self.files = Files(spark, root)
        self.root = self.files.root

    def history(self) -> list[Version]:
        """All switches that are still known, the current one last."""
        text = self.files.read(POINTER)
        if text and not text.startswith("["):  # a pointer without a history: the name alone
            return [Version(text, 0.0)]
        return [Version(*entry) for entry in json.loads(text)] if text else []

    def current(self) -> str | None:
        """The folder of the current version; None before the first one."""
        history = self.history()
        return f"{self.root}/{history[-1].name}" if history else None

    def _switch(self, seen: list[Version], history: list[Version]) -> None:
        if self.history() != seen:
            raise ConcurrentWrite(f"{self.root} was switched by another writer")
        self.files.write(POINTER, json.dumps([[v.name, v.at] for v in history]))

    def replace(self, write: Callable[[str], None]) -> str:
        """``write(folder)`` fills a new version, which then becomes current."""
        seen = self.history()
        name = f"v-{uuid.uuid4().hex[:12]}"
        write(f"{self.root}/{name}")
        self._switch(seen, [*seen, Version(name, time.time())])
        return f"{self.root}/{name}"

    def roll_back(self, name: str | None = None) -> str:
        """Make an earlier version current again; by default the one before the current."""
        seen = self.history()
        known = [v.name for v in seen]
        if name is None:
            earlier = [n for n in known if n != known[-1]] if known else []
            if not earlier:
                raise ValueError(f"{self.root} has no earlier version")
            name = earlier[-1]
        if name not in known or not self.files.exists(name):
            raise ValueError(f"{self.root} does not hold version {name!r}")
        self._switch(seen, [*seen, Version(name, time.time())])
        return f"{self.root}/{name}"

    @staticmethod
    def oldest(younger_than: float) -> float:
        return time.time() - younger_than

    def retained(self, keep: int, younger_than: float) -> list[Version]:
        """The switches that a clean-up leaves in the history."""
        history, oldest = self.history(), self.oldest(younger_than)
        last = list(dict.fromkeys(v.name for v in reversed(history)))[:max(keep, 1)]
        return [v for v in history if v.name in last or v.at >= oldest]

    def clean(self, keep: int = 3, younger_than: float = 86_400.0) -> list[str]:
        """Remove what is neither among the last ``keep`` versions nor younger
        than ``younger_than`` seconds, left-overs of failed writers included;
        returns the removed folders' names. The history forgets them first."""
        seen, kept = self.history(), self.retained(keep, younger_than)
        if kept != seen:
            self._switch(seen, kept)
        names, oldest = {v.name for v in kept}, self.oldest(younger_than)
        gone = [n for n, at in self.files.folders().items() if n.startswith("v-") and n not in names and at < oldest]
        for n in gone:
            self.files.remove(n)
        return sorted(gone)

"""A topic log in files, with offsets: a source and a sink on Spark's Python Data Source API.

Topics keep their messages in segment files, and every message has an offset in its
partition, as with a broker, but without one. A log lies in one folder:

    <topic>/<partition>/<first offset>-<last offset>.parquet   segments
    <topic>/<partition>/_staged/…                              segments before their offsets are known

Publishing (``df.write.format("topic_log")``) writes staged files in the tasks, one
for each partition that a task has messages of; the job's commit then gives each file
its offsets and moves it into place. A job that fails leaves staged files that nobody
reads; the move is the commit, so a message is there once or not at all. Publishing
to one topic is for one writer at a time: the move of a taken offset range fails.

Reading (``spark.read`` or ``spark.readStream``) takes ``startingOffsets`` and, for
bounded scans, ``endingOffsets``: ``earliest``, ``latest``, or JSON such as
``{"events": {"0": 23, "1": -2}}`` with -2 for the earliest and -1 for the latest;
partitions that are not named start at the earliest and end at the latest. A stream
keeps the offsets it has read up to in its checkpoint: a restart goes on there,
whatever ``startingOffsets`` says. A batch takes all that is there (the API does not
tell a reader where the checkpoint stands, so it cannot bound a batch); what bounds
the work of a task is ``offsetsPerSplit``.

Input partitions are runs of at most that many offsets of one topic partition, and read only the segments and row groups that they touch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition,
                                    WriterCommitMessage)
from pyspark.sql.types import StructType

FORMAT = "topic_log"
EARLIEST, LATEST = -2, -1
#: Columns of a message as stored; reads add topic, partition and offset.
_STORED = pa.schema([("key", pa.string()), ("value", pa.string()), ("timestamp", pa.timestamp("us"))])
SCHEMA = "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP_NTZ"


class TopicFiles:
    """Segments of the topics under a folder of any file system that Arrow knows."""

    def __init__(self, uri: str):
        if uri.startswith("file:"):
            uri = "/" + uri.removeprefix("file:").lstrip("/")
        self.store, self.root = fs.FileSystem.from_uri(uri)

    def _names(self, path: str, kind: fs.FileType) -> list[str]:
        found = self.store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return sorted(f.base_name for f in found if f.type == kind and not f.base_name.startswith(("_", ".")))

    def topics(self) -> list[str]:
        return self._names(self.root, fs.FileType.Directory)

    def partitions(self, topic: str) -> list[int]:
        return sorted(int(n) for n in self._names(f"{self.root}/{topic}", fs.FileType.Directory))

    def segments(self, topic: str, partition: int) -> list[tuple[int, int, str]]:
        """(first offset, offset after the last, path), in offset order."""
        folder = f"{self.root}/{topic}/{partition}"
        out = []
        for name in self._names(folder, fs.FileType.File):
            first, last = name.removesuffix(".parquet").split("-")
            out.append((int(first), int(last) + 1, f"{folder}/{name}"))
        return sorted(out)

    def bounds(self, topic: str, partition: int) -> tuple[int, int]:
        """The first offset that is still kept, and the next one to be given."""
        segments = self.segments(topic, partition)
        return (segments[0][0], segments[-1][1]) if segments else (0, 0)


def _topics(options) -> list[str]:
    names = [t.strip() for t in options.get("subscribe", "").split(",") if t.strip()]
    if not names:
        raise ValueError("subscribe must name at least one topic")
    return names


def resolved(files: TopicFiles, topics: list[str], wanted: str, default: int) -> dict[str, dict[str, int]]:
    """Offsets per topic and partition for ``earliest``, ``latest`` or a JSON text."""
    named = {} if wanted in ("earliest", "latest") else json.loads(wanted)
    default = {"earliest": EARLIEST, "latest": LATEST}.get(wanted, default)
    out: dict[str, dict[str, int]] = {}
    for topic in topics:
        asked = {int(p): int(o) for p, o in named.get(topic, {}).items()}
        out[topic] = {}
        for partition in sorted({*files.partitions(topic), *asked}):
            low, high = files.bounds(topic, partition)
            at = asked.get(partition, default)
            if at >= 0 and not low <= at <= high:
                raise ValueError(f"offset {at} of {topic} {partition} is not within {low} and {high}")
            out[topic][str(partition)] = low if at == EARLIEST else high if at == LATEST else at
    return out


@dataclass
class OffsetRun(InputPartition):
    """Offsets ``start`` to ``end`` (not included) of one topic partition."""

    topic: str
    partition: int
    start: int
    end: int


def runs(start: dict, end: dict, longest: int) -> list[OffsetRun]:
    out = []
    for topic, partitions in end.items():
        for p, upto in partitions.items():
            at = start.get(topic, {}).get(p, 0)
            while at < upto:
                out.append(OffsetRun(topic, int(p), at, min(at + longest, upto)))
                at = out[-1].end
    return out


def read_run(uri: str, run: OffsetRun) -> Iterator[pa.RecordBatch]:
    """The messages of a run; only segments and row groups that hold some are read."""
    files, expected = TopicFiles(uri), run.start
    for first, after, path in files.segments(run.topic, run.partition):
        if after <= run.start or first >= run.end:
            continue
        if first > expected:
            break
        with files.store.open_input_file(path) as f:
            segment, at = pq.ParquetFile(f), first
            for g in range(segment.num_row_groups):
                n = segment.metadata.row_group(g).num_rows
                if at < run.end and at + n > run.start:
                    low, high = max(run.start - at, 0), min(run.end - at, n)
                    for b in segment.read_row_group(g).slice(low, high - low).to_batches(10_000):
                        offsets = pa.array(range(expected, expected + b.num_rows), pa.int64())
                        expected += b.num_rows
                        yield pa.RecordBatch.from_arrays(
                            [b.column("key"), b.column("value"), pa.array([run.topic] * b.num_rows), pa.array([run.partition] * b.num_rows, pa.int32()),
                             offsets, b.column("timestamp")], ["key", "value", "topic", "partition", "offset", "timestamp"])
                at += n
    if expected != run.end:
        raise ValueError(f"offset {expected} of {run.topic} {run.partition} is no longer kept")


class _Options:
    def __init__(self, options):
        self.uri, self.topics = options["path"], _topics(options)
        self.start = options.get("startingOffsets", "earliest")
        self.end = options.get("endingOffsets", "latest")
        self.longest = int(options.get("offsetsPerSplit", 1_000_000))


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.o = _Options(options)

    def partitions(self) -> list[OffsetRun]:
        files = TopicFiles(self.o.uri)
        start = resolved(files, self.o.topics, self.o.start, EARLIEST)
        found = runs(start, resolved(files, self.o.topics, self.o.end, LATEST), self.o.longest)
        return found or [OffsetRun(self.o.topics[0], 0, 0, 0)]

    def read(self, partition: OffsetRun) -> Iterator[pa.RecordBatch]:
        return read_run(self.o.uri, partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are {topic: {partition: next offset}}; Spark keeps them in the checkpoint."""

    def __init__(self, options):
        self.o = _Options(options)

    def initialOffset(self) -> dict:
        return resolved(TopicFiles(self.o.uri), self.o.topics, self.o.start, EARLIEST)

    def latestOffset(self) -> dict:
        return resolved(TopicFiles(self.o.uri), self.o.topics, "latest", LATEST)

    def partitions(self, start: dict, end: dict) -> list[OffsetRun]:
        return runs(start, end, self.o.longest)

    def read(self, partition: OffsetRun) -> Iterator[pa.RecordBatch]:
        return read_run(self.o.uri, partition)


@dataclass
class _Staged(WriterCommitMessage):
    files: list[tuple[str, int, str, int]]  # topic, partition, path, messages


class _Writer(DataSourceArrowWriter):
    def __init__(self, options):
        self.uri = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Staged:
        files, writers = TopicFiles(self.uri), {}
        for b in iterator:
            table = pa.Table.from_batches([b])
            places = table.select(["topic", "partition"]).group_by(["topic", "partition"]).aggregate([])
            for topic, partition in zip(places["topic"].to_pylist(), places["partition"].to_pylist(), strict=True):
                mine = pc.and_(pc.equal(table["topic"], topic), pc.equal(table["partition"], partition))
                if (topic, partition) not in writers:
                    folder = f"{files.root}/{topic}/{partition}/_staged"
                    files.store.create_dir(folder, recursive=True)
                    path = f"{folder}/{uuid.uuid4().hex}.parquet"
                    writers[topic, partition] = [pq.ParquetWriter(files.store.open_output_stream(path), _STORED), path, 0]
                held = writers[topic, partition]
                rows = table.filter(mine).select(_STORED.names).cast(_STORED)
                held[0].write_table(rows, row_group_size=100_000)
                held[2] += rows.num_rows
        for held in writers.values():
            held[0].close()
        return _Staged([(t, p, held[1], held[2]) for (t, p), held in writers.items()])

    def commit(self, messages: list[_Staged | None]) -> None:
        files, following = TopicFiles(self.uri), {}
        for topic, partition, path, n in sorted(f for m in messages if m is not None for f in m.files):
            if (topic, partition) not in following:
                following[topic, partition] = files.bounds(topic, partition)[1]
            first = following[topic, partition]
            target = f"{files.root}/{topic}/{partition}/{first:020d}-{first + n - 1:020d}.parquet"
            if files.store.get_file_info(target).type != fs.FileType.NotFound:
                raise ValueError(f"another writer has taken offset {first} of {topic} {partition}")
            files.store.move(path, target)
            following[topic, partition] = first + n

    def abort(self, messages: list[_Staged | None]) -> None:
        files = TopicFiles(self.uri)
        for _, _, path, _ in (f for m in messages if m is not None for f in m.files):
            files.store.delete_file(path)


class TopicLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("messages are appended to a topic log")
        return _Writer(self.options)


def publish(messages: DataFrame, root: str, partitions: int = 4) -> None:
    """Append ``key, value, topic, timestamp`` rows to a topic log. Messages of one
    key go to one partition, keyless ones to the partition of their value."""
    messages.sparkSession.dataSource.register(TopicLogSource)
    place = F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(partitions)).cast("int")
    messages.select("key", "value", "topic", place.alias("partition"), "timestamp") \
        .write.format(FORMAT).mode("append").option("path", root).save()


@dataclass(frozen=True)
class LogTopics:
    """Topics of a log as a source of the router; the options are those of the module's text."""

    root: str
    starting_offsets: str = "earliest"
    ending_offsets: str = "latest"
    offsets_per_split: int = 1_000_000

    def _load(self, reader, topics: list[str]):
        return (reader.format(FORMAT).option("path", self.root).option("subscribe", ",".join(topics))
                .option("startingOffsets", self.starting_offsets).option("offsetsPerSplit", self.offsets_per_split))

    def stream_offsets(self, spark: SparkSession, topics: list[str]) -> DataFrame:
        spark.dataSource.register(TopicLogSource)
        return self._load(spark.readStream, topics).load()

    def batch_offsets(self, spark: SparkSession, topics: list[str]) -> DataFrame:
        spark.dataSource.register(TopicLogSource)
        return self._load(spark.read, topics).option("endingOffsets", self.ending_offsets).load()

    def stream(self, spark: SparkSession, topics: list[str]) -> DataFrame:
        return self.stream_offsets(spark, topics).select("key", "value", "topic", "timestamp")

    def batch(self, spark: SparkSession, topics: list[str]) -> DataFrame:
        """Bounded scan between the given offsets (S2)."""
        return self.batch_offsets(spark, topics).select("key", "value", "topic", "timestamp")

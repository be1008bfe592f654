"""Topic sources: Kafka, or directories of message files with the same columns.

Both give ``key, value, topic, timestamp`` with key and value as text, as a
stream (``stream``) or a bounded scan (``batch``). A streaming read starts at
the earliest offset unless told otherwise, so a new query never skips
messages that arrived before it started.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchtrace import config as C
from batchtrace import schemas


def _decoded(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"),
                     F.col("topic").cast("string").alias("topic"),
                     F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


@dataclass(frozen=True)
class KafkaTopics:
    """Kafka topics (needs the Kafka connector on the classpath)."""

    bootstrap_servers: str
    starting_offsets: str = "earliest"
    options: dict = field(default_factory=dict)

    def _reader(self, reader, topics: list[str]):
        r = (reader.format("kafka")
             .option("kafka.bootstrap.servers", self.bootstrap_servers)
             .option("subscribe", ",".join(topics))
             .option("startingOffsets", self.starting_offsets))
        for k, v in self.options.items():
            r = r.option(k, v)
        return r

    def stream(self, spark: SparkSession, topics: list[str]) -> DataFrame:
        return _decoded(self._reader(spark.readStream, topics).load())

    def batch(self, spark: SparkSession, topics: list[str]) -> DataFrame:
        """Bounded scan from the earliest to the latest offset (S2)."""
        return _decoded(self._reader(spark.read, topics).option("endingOffsets", "latest").load())


@dataclass(frozen=True)
class FileTopics:
    """Message files under ``root/topic=<name>/`` (Parquet, declared schema).

    ``max_files_per_trigger``, if given, bounds each micro-batch, so a backlog
    is taken in several batches; by default a batch takes all that is there.
    """

    root: str
    max_files_per_trigger: int | None = None

    _SCHEMA = schemas.RAW_MESSAGE

    def stream(self, spark: SparkSession, topics: list[str]) -> DataFrame:
        r = spark.readStream.schema(self._SCHEMA)
        if self.max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return r.parquet(self.root).filter(F.col("topic").isin(*topics)).select(*self._SCHEMA.fieldNames())

    def batch(self, spark: SparkSession, topics: list[str]) -> DataFrame:
        return (spark.read.schema(self._SCHEMA).parquet(self.root)
                .filter(F.col("topic").isin(*topics)).select(*self._SCHEMA.fieldNames()))


def publish_files(messages: DataFrame, root: str) -> None:
    """Append messages to file topics (one directory per topic), keyed as
    given. Every input partition publishes its own messages."""
    messages.write.mode("append").partitionBy("topic").parquet(root)


@dataclass(frozen=True)
class RoutedFiles:
    """The router's file output (partitioned by ``route``) read as topics.

    Reading the output root lets a stream use the sink's commit log, so only
    committed router batches are seen; the route filter prunes directories.
    """

    path: str
    max_files_per_trigger: int | None = None

    def stream_routes(self, spark: SparkSession) -> DataFrame:
        """All routes as one stream, with their ``route`` column."""
        r = spark.readStream.schema(schemas.ROUTED)
        if self.max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return r.parquet(self.path)

    def stream(self, spark: SparkSession, route: str) -> DataFrame:
        return self.stream_routes(spark).filter(F.col("route") == route)

    def batch(self, spark: SparkSession, route: str) -> DataFrame:
        return spark.read.schema(schemas.ROUTED).parquet(self.path).filter(F.col("route") == route)


@dataclass(frozen=True)
class RoutedKafka:
    """The router's Kafka output read per route: clean kitchen, clean
    dispatch and dead-letter topics (same interface as ``RoutedFiles``)."""

    kafka: KafkaTopics
    topics: C.Topics = C.Topics()

    def _topic(self, route: str) -> str:
        return {C.ROUTE_CLEAN_KITCHEN: self.topics.clean_kitchen,
                C.ROUTE_CLEAN_DISPATCH: self.topics.clean_dispatch,
                C.ROUTE_DLQ: self.topics.dlq}[route]

    def stream_routes(self, spark: SparkSession) -> DataFrame:
        """All routes as one stream; the topic says which."""
        of_topic = {self._topic(r): r for r in (C.ROUTE_CLEAN_KITCHEN, C.ROUTE_CLEAN_DISPATCH, C.ROUTE_DLQ)}
        pairs = [F.lit(x) for pair in of_topic.items() for x in pair]
        return self.kafka.stream(spark, list(of_topic)).withColumn("route", F.element_at(F.create_map(*pairs), F.col("topic")))

    def stream(self, spark: SparkSession, route: str) -> DataFrame:
        return self.kafka.stream(spark, [self._topic(route)])

    def batch(self, spark: SparkSession, route: str) -> DataFrame:
        return self.kafka.batch(spark, [self._topic(route)])

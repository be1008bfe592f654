"""File sinks: curated tables, CSV reports, document snapshots.

All writes are distributed (executors write their own files); nothing is
collected to the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from batchtrace.sinks.versions import Files, VersionedFolder


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
                mode: str = "append", fmt: str = "parquet") -> None:
    """Append (or overwrite) a table; ``partition_by`` makes one directory per
    value, so later filters on that column prune whole directories."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_lookup_table(df: DataFrame, path: str, key: str, partition_by: tuple[str, ...] = (),
                       mode: str = "append") -> None:
    """A Parquet table laid out for lookups by ``key``.

    Rows are range-partitioned by (partition columns, key) and sorted, so each
    directory has few files, a large directory is split among tasks by key
    ranges, row-group statistics are narrow, and a Bloom filter on the key lets
    a lookup skip the row groups that statistics leave over.
    """
    order = (*partition_by, key)
    w = (df.repartitionByRange(*order).sortWithinPartitions(*order)
         .write.mode(mode).option(f"parquet.bloom.filter.enabled#{key}", "true"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def compact_table(spark: SparkSession, path: str, schema: StructType, out: str, key: str,
                  partition_by: tuple[str, ...] = ()) -> None:
    """A streamed table (many small files) rewritten as a lookup table. Reads
    only what the stream has committed."""
    write_lookup_table(spark.read.schema(schema).parquet(path), out, key, partition_by, mode="overwrite")


def write_csv_report(report: DataFrame, path: str) -> None:
    """One report per directory: header line, overwrite (S8).

    The report is written beside the old one and put in its place when it is
    whole, so a failed job keeps the old report.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    new = f"_new-{uuid.uuid4().hex[:12]}-{name}"
    files = Files(report.sparkSession, folder)
    try:
        report.write.option("header", "true").csv(f"{folder}/{new}")
        files.swap(new, name)
    finally:
        files.remove(new)


def read_csv_report(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a CSV report back with its declared schema (no inference pass)."""
    return spark.read.option("header", "true").schema(schema).csv(path)


def write_document_snapshot(docs: DataFrame, path: str, fmt: str = "json") -> str:
    """Replace a document collection with the rows of ``docs``, nested columns
    kept as nested documents (S9). A failed job keeps the old collection."""
    return VersionedFolder(docs.sparkSession, path).replace(lambda folder: docs.write.format(fmt).save(folder))


def clean_document_snapshots(spark: SparkSession, path: str, keep: int = 3, younger_than: float = 86_400.0) -> list[str]:
    """Remove older snapshots of a collection; see ``VersionedFolder.clean``."""
    return VersionedFolder(spark, path).clean(keep, younger_than)


def roll_back_document_snapshot(spark: SparkSession, path: str, version: str | None = None) -> str:
    """Make an earlier snapshot current again, by default the one before the current."""
    return VersionedFolder(spark, path).roll_back(version)


def read_document_snapshot(spark: SparkSession, path: str, schema: StructType, fmt: str = "json") -> DataFrame:
    """The current documents; none before the first snapshot."""
    folder = VersionedFolder(spark, path).current()
    return spark.read.schema(schema).format(fmt).load(folder) if folder else spark.createDataFrame([], schema)

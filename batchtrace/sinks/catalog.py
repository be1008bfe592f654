"""Stored tables in the session's catalog.

A table is declared once, with its columns and its partitions, and is then read by
name: Spark keeps the relation and the file listing, asks the catalog which
partitions a filter needs, and lists only those, once. So a query starts no listing
of its own, however many dates there are, and the tables answer ``spark.sql`` too.
Writers declare again what they have rewritten (``recover``), which drops what was
kept of the old files.

Tables may be bucketed by a key: joins and aggregations on it then need no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Partitions declared by one statement.
_AT_ONCE = 200


def table_name(*what: str) -> str:
    """A catalog name that belongs to a folder (and version), e.g. ``bt_3f2a_kitchen``."""
    *place, name = what
    return f"bt_{hashlib.md5('|'.join(place).encode()).hexdigest()[:12]}_{name}"


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def declare(spark: SparkSession, name: str, schema: StructType, folder: str, partition_by: tuple[str, ...] = (),
            key: str | None = None, buckets: int = 0) -> None:
    """An external Parquet table over ``folder``; partitions are declared apart."""
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    bucketed = f" CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS" if key and buckets else ""
    spark.sql(f"CREATE TABLE `{name}` ({_columns(schema)}) USING parquet{parts}{bucketed} LOCATION {_literal(folder)}")


def recover(spark: SparkSession, name: str, schema: StructType, folder: str, partition_by: tuple[str, ...] = ()) -> None:
    """Declare a table over what is stored in ``folder`` now."""
    forget(spark, name)
    declare(spark, name, schema, folder, partition_by)
    if partition_by:
        spark.sql(f"ALTER TABLE `{name}` RECOVER PARTITIONS")


def add_parts(spark: SparkSession, name: str, column: str, folders: Mapping[str, str]) -> None:
    """Partitions that each lie in a folder of their own."""
    every = [f"PARTITION (`{column}` = {_literal(value)}) LOCATION {_literal(folder)}" for value, folder in folders.items()]
    for at in range(0, len(every), _AT_ONCE):
        spark.sql(f"ALTER TABLE `{name}` ADD IF NOT EXISTS {' '.join(every[at:at + _AT_ONCE])}")


def forget(spark: SparkSession, name: str) -> None:
    """Drop the declaration; the files stay."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def declared(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(f"`{name}`")

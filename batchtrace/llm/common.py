"""Helpers shared by the training-data operators.

Conventions of every operator in this subpackage:

* it selects the columns it needs by name, so extra columns of the input (also
  ones named like a result column) never reach its plan;
* a null text counts as the empty text unless the operator says otherwise;
* rows that repeat (same id, same text) each get their own result row;
* an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchtrace.session import ensure_checkpoint_dir, scratch_path

#: Rows that may be broadcast; a few columns wide, so at most some tens of MB.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder of the shared scratch space and read back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored frame, marked for broadcast only if its counted rows are few.

    Beyond ``max_rows`` it is returned unmarked and the join shuffles.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def at_most(rows: DataFrame, bound: int) -> DataFrame:
    """A stored sample, thinned at random to ``bound`` rows if it has more."""
    return rows if rows.count() <= bound else rows.orderBy(F.rand(7)).limit(bound)


def fold(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null ids: fold of '')."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def file_order(df: DataFrame) -> list[Column] | None:
    """Columns that tell the written order of rows read straight from Parquet files; None for other frames."""
    place = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    try:
        df.select(*place)
    except AnalysisException:
        return None
    return place


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"{n}_"
        taken.add(n.lower())
        out.append(n)
    return out


def chunks(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``max_bytes`` of text, or one row.

    Python objects made from a slice are freed before the next one, so a task's
    memory depends on this bound and its longest text, not on the batch size.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if total and total + n > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(sizes):
            yield batch.slice(start)

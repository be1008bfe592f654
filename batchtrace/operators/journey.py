"""Batch journeys, existence checks, delivery spans and the driver league table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchtrace import config as C
from batchtrace.functions.period import first_rows, require_id

JOURNEY_COLUMNS = ("batch_id", "event_id", "event_timestamp", "source", "action", "location",
                   "station_id", "driver_id", "canteen_id")


def _label(prefix: str, col: str) -> Column:
    # The display form of a possibly missing id ("Station None").
    return F.concat(F.lit(prefix), F.coalesce(F.col(col), F.lit("None")))


def batch_dates(k: DataFrame, d: DataFrame) -> DataFrame:
    """The key -> dates index: the dates on which a batch has kitchen or dispatch
    rows, and how many; undated rows have a null date. Counted before the shuffle,
    so a hot batch ships one row a date and task."""
    parts = [df.filter(F.col("batch_id").isNotNull()).select(
        "batch_id", "event_date", F.lit(int(i == 0)).alias("in_k"), F.lit(int(i == 1)).alias("in_d")) for i, df in enumerate((k, d))]
    return parts[0].unionAll(parts[1]).groupBy("batch_id", "event_date").agg(
        F.sum("in_k").alias("kitchen_rows"), F.sum("in_d").alias("dispatch_rows"))


def _on_dates(df: DataFrame, dates: list) -> DataFrame:
    """Rows of the given dates (None: undated); prunes a table stored by date to their directories."""
    known = sorted(x for x in dates if x is not None)
    on = F.col("event_date").isin(known) if known else F.lit(False)
    return df.filter(on | F.col("event_date").isNull() if None in dates else on)


def narrowed(k: DataFrame, d: DataFrame, batch_id: str, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables cut to the dates that hold the batch, looked up in the index (one row a date)."""
    held = index.filter(F.col("batch_id") == require_id(batch_id, "batch id")).collect()
    return (_on_dates(k, [r["event_date"] for r in held if r["kitchen_rows"]]),
            _on_dates(d, [r["event_date"] for r in held if r["dispatch_rows"]]))


def batch_journey(k: DataFrame, d: DataFrame, batch_id: str, index: DataFrame | None = None) -> DataFrame:
    """All kitchen and dispatch rows of one batch, tagged and in time order
    (kitchen before dispatch on equal times). The equality on ``batch_id``
    reaches the Parquet scan as a pushed filter; with a ``batch_dates`` index
    only the dates that hold the batch are opened."""
    b = require_id(batch_id, "batch id")
    if index is not None:
        k, d = narrowed(k, d, b, index)
    kitchen = (k.filter(F.col("batch_id") == b)
               .select("batch_id", "event_id", "event_timestamp", "action", "station_id",
                       F.lit(C.SOURCE_KITCHEN).alias("source"),
                       _label(C.STATION_PREFIX, "station_id").alias("location")))
    dispatch = (d.filter(F.col("batch_id") == b)
                .select("batch_id", "event_id", "event_timestamp", "action", "driver_id", "canteen_id",
                        F.lit(C.SOURCE_DISPATCH).alias("source"),
                        _label(C.DRIVER_PREFIX, "driver_id").alias("location")))
    return (kitchen.unionByName(dispatch, allowMissingColumns=True)
            .select(*JOURNEY_COLUMNS)
            .orderBy(F.col("event_timestamp").asc_nulls_first(), F.col("source").desc(), "event_id"))


def indexed_batch_exists(index: DataFrame, batch_id: str) -> DataFrame:
    """The answer of ``batch_exists`` from the ``batch_dates`` index alone."""
    b = require_id(batch_id, "batch id")
    seen = index.filter(F.col("batch_id") == b).agg(
        F.coalesce(F.sum("kitchen_rows") > 0, F.lit(False)).alias("in_kitchen"),
        F.coalesce(F.sum("dispatch_rows") > 0, F.lit(False)).alias("in_dispatch"))
    return seen.select(F.lit(b).alias("batch_id"), "in_kitchen", "in_dispatch",
                       (F.col("in_kitchen") | F.col("in_dispatch")).alias("found"))


def batch_exists(k: DataFrame, d: DataFrame, batch_id: str) -> DataFrame:
    """One row: whether the batch has kitchen rows, dispatch rows, and any.

    Each side stops at its first match (``limit(1)``); with the stored tables'
    order and Bloom filters a batch that is absent reads no row group."""
    b = require_id(batch_id, "batch id")

    def any_of(df: DataFrame, tag: str) -> DataFrame:
        return df.filter(F.col("batch_id") == b).select(F.lit(tag).alias("_t")).limit(1)

    t = F.col("_t")
    seen = any_of(k, "k").unionByName(any_of(d, "d")).agg(
        F.coalesce(F.bool_or(t == "k"), F.lit(False)).alias("in_kitchen"),
        F.coalesce(F.bool_or(t == "d"), F.lit(False)).alias("in_dispatch"))
    return seen.select(F.lit(b).alias("batch_id"), "in_kitchen", "in_dispatch",
                       (F.col("in_kitchen") | F.col("in_dispatch")).alias("found"))


def minute_of(ts_text: Column) -> Column:
    """The instant of the timestamp text, truncated to the minute. An offset in
    the text is honoured; a text without one is in the session's zone (UTC)."""
    whole = F.regexp_replace(ts_text, r"T(\d\d:\d\d)(Z|[+-]\d\d:?\d\d)$", "T$1:00$2")  # the cast wants seconds before an offset
    return F.date_trunc("MINUTE", whole.try_cast("timestamp"))


def delivery_spans(d: DataFrame) -> DataFrame:
    """Per (batch, driver): first and last of the LOADING / DELIVERED times
    (text min / max), and the minutes between them counted as minute
    boundaries crossed. Spans of zero or less, or unparsable, are dropped.

    A partial aggregation: a hot driver ships one row per batch per task."""
    spans = (d.filter(F.col("action").isin(C.LOADING, C.DELIVERED))
             .groupBy("batch_id", "driver_id")
             .agg(F.min("event_timestamp").alias("start_time"),
                  F.max("event_timestamp").alias("end_time")))
    mins = F.timestamp_diff("MINUTE", minute_of(F.col("start_time")), minute_of(F.col("end_time")))
    return (spans.withColumn("delivery_time_mins", mins)
            .filter(F.col("delivery_time_mins") > 0))


def driver_leaderboard(d: DataFrame, limit: int | None = None) -> DataFrame:
    """Drivers by average delivery minutes (ascending, then driver id), with
    1-based rank, min, max, average and number of deliveries."""
    per_driver = (delivery_spans(d)
                  .groupBy("driver_id")
                  .agg(F.min("delivery_time_mins").alias("min_time"),
                       F.max("delivery_time_mins").alias("max_time"),
                       F.avg("delivery_time_mins").alias("avg_time"),
                       F.count(F.lit(1)).alias("total_deliveries")))
    # One row per driver is left: the rank needs one ordered pass over them.
    rank = F.row_number().over(Window.orderBy(F.col("avg_time").asc(), F.col("driver_id").asc_nulls_first()))
    ranked = per_driver.select(rank.cast("long").alias("rank"), "driver_id", "min_time", "max_time", "avg_time",
                               "total_deliveries")
    return first_rows(ranked, limit)

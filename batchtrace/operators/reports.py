"""Period reports over the curated kitchen (K), dispatch (D) and DLQ (Q) frames.

Every report is one filter on the stored ``event_date`` column (partition
pruning + Parquet pushdown), one aggregation with partial aggregation on the
map side (so a hot station or driver costs one row per map task in the
shuffle), and a sort of the small result. Every report takes a ``limit`` for
display; None means all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchtrace import config as C
from batchtrace.functions.period import Period, as_period, first_rows

# Columns of the listings, in order.
KITCHEN_LISTING_COLUMNS = (
    "event_timestamp", "batch_id", "recipe_id", "station_id", "action",
    "temperature_celsius", "weight_kg", "temperature_status", "weight_status", "sensor_status",
)
DISPATCH_LISTING_COLUMNS = (
    "event_timestamp", "batch_id", "driver_id", "canteen_id", "action",
    "truck_temp_celsius", "temperature_status", "sensor_status",
)


def _count_if(cond: Column) -> Column:
    # count(when(cond, true)): a null condition is not counted.
    return F.count(F.when(cond, F.lit(True)))


def _in_period(df: DataFrame, period: Period | str) -> DataFrame:
    return df.filter(as_period(period).contains("event_date"))


def kitchen_listing(k: DataFrame, period: Period | str, limit: int | None = None) -> DataFrame:
    """Kitchen rows of the period, ten columns, in time order."""
    out = (_in_period(k, period)
           .select(*KITCHEN_LISTING_COLUMNS, "event_id")
           .orderBy(F.col("event_timestamp").asc_nulls_first(), "event_id")
           .drop("event_id"))
    return first_rows(out, limit)


def dispatch_listing(d: DataFrame, period: Period | str, limit: int | None = None) -> DataFrame:
    """Dispatch rows of the period, eight columns, in time order."""
    out = (_in_period(d, period)
           .select(*DISPATCH_LISTING_COLUMNS, "event_id")
           .orderBy(F.col("event_timestamp").asc_nulls_first(), "event_id")
           .drop("event_id"))
    return first_rows(out, limit)


def station_counts() -> list[Column]:
    """A weight status of UNKNOWN counts as a weight warning."""
    return [_count_if(F.col("action").isin(*C.KITCHEN_ACTIONS)).alias("total_times_active"),
            _count_if(F.col("temperature_status") != C.OK).alias("total_temp_warnings"),
            _count_if(F.col("weight_status") != C.OK).alias("total_weight_warnings"),
            _count_if(F.col("sensor_status") != C.OK).alias("total_sensor_warnings")]


def recipe_counts() -> list[Column]:
    return [_count_if(F.col("action") == C.COOKING).alias("total_times_cooked")]


def driver_counts() -> list[Column]:
    return [_count_if(F.col("action") == C.DELIVERED).alias("total_deliveries"),
            _count_if(F.col("temperature_status") != C.OK).alias("total_truck_temp_warnings"),
            _count_if(F.col("sensor_status") != C.OK).alias("total_sensor_warnings")]


def canteen_counts() -> list[Column]:
    return [_count_if(F.col("action") == C.DELIVERED).alias("total_deliveries")]


def station_report(k: DataFrame, period: Period | str, limit: int | None = None) -> DataFrame:
    """Per station: active steps, temperature / weight / sensor warnings.

    A weight status of UNKNOWN counts as a weight warning.
    """
    out = (_in_period(k, period)
            .groupBy("station_id")
            .agg(*station_counts())
            .orderBy("station_id"))
    return first_rows(out, limit)


def recipe_report(k: DataFrame, period: Period | str, limit: int | None = None) -> DataFrame:
    """Per recipe: COOKING steps (recipes with none keep a zero row)."""
    out = (_in_period(k, period)
            .groupBy("recipe_id")
            .agg(*recipe_counts())
            .orderBy("recipe_id"))
    return first_rows(out, limit)


def one_row_per_batch(k: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """The earliest row (by event_timestamp, then event_id) of each batch.

    An aggregation, not a window: ``min_by`` combines partially before the
    shuffle, so a batch with a third of all rows ships one row per map task.
    """
    pick = F.min_by(F.struct(*cols), F.struct(F.col("event_timestamp"), F.col("event_id")))
    return k.groupBy("batch_id").agg(pick.alias("_row")).select("batch_id", "_row.*")


def ingredient_usage(k: DataFrame, period: Period | str, limit: int | None = None) -> DataFrame:
    """Ingredient weight per (recipe, item): one row per batch in the period,
    its ingredient list exploded, amounts summed and rounded to 2 places;
    heaviest first."""
    per_batch = one_row_per_batch(_in_period(k, period), ("recipe_id", "ingredients"))
    out = (per_batch
           .select("recipe_id", F.inline("ingredients"))
           .groupBy("recipe_id", "item")
           .agg(F.round(F.sum(F.col("amount_kg").cast("double")), 2).alias("total_weight_used"))
           .orderBy(F.col("total_weight_used").desc_nulls_last(), "recipe_id", "item"))
    return first_rows(out, limit)


def driver_report(d: DataFrame, period: Period | str, limit: int | None = None) -> DataFrame:
    """Per driver: deliveries, warm-truck warnings, sensor warnings."""
    out = (_in_period(d, period)
            .groupBy("driver_id")
            .agg(*driver_counts())
            .orderBy("driver_id"))
    return first_rows(out, limit)


def canteen_report(d: DataFrame, period: Period | str, limit: int | None = None) -> DataFrame:
    """Per canteen: deliveries."""
    out = (_in_period(d, period)
            .groupBy("canteen_id")
            .agg(*canteen_counts())
            .orderBy("canteen_id"))
    return first_rows(out, limit)


def batch_count(k: DataFrame, d: DataFrame, period: Period | str) -> DataFrame:
    """Distinct batch ids over both tables in the period (null counts once).

    ``union`` + ``distinct`` (partial aggregation on each side) rather than
    ``count(distinct)``, which would skip the null id.
    """
    ids = _in_period(k, period).select("batch_id").union(_in_period(d, period).select("batch_id"))
    return ids.distinct().agg(F.count(F.lit(1)).alias("total_batches"))


def row_counts(k: DataFrame, d: DataFrame, q: DataFrame, period: Period | str) -> DataFrame:
    """One row: kitchen, dispatch and dated DLQ rows in the period, and all
    undated DLQ rows. One union of tag columns, one global aggregate."""
    p = as_period(period)
    tagged = (k.filter(p.contains("event_date")).select(F.lit("k").alias("_t"))
              .unionByName(d.filter(p.contains("event_date")).select(F.lit("d").alias("_t")))
              .unionByName(q.filter(p.contains("event_date") | F.col("event_date").isNull())
                           .select(F.when(F.col("event_date").isNull(), F.lit("u"))
                                   .otherwise(F.lit("q")).alias("_t"))))
    t = F.col("_t")
    return tagged.agg(_count_if(t == "k").alias("kitchen_events"),
                      _count_if(t == "d").alias("dispatch_events"),
                      _count_if(t == "q").alias("dlq_events"),
                      _count_if(t == "u").alias("dlq_undated_events"))


PREVIEW_ROWS = 200


def preview(df: DataFrame, n: int = PREVIEW_ROWS, order_by: str = "event_timestamp") -> DataFrame:
    """The first ``n`` rows of a curated or raw archive table in time order,
    by event id or message key on equal times (S11); planned as a top-k
    (``TakeOrderedAndProject``), not a full sort."""
    ties = [c for c in ("event_id", "message_key", "raw_message") if c in df.columns]
    return df.orderBy(F.col(order_by).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in ties]).limit(n)

"""Per-day partial aggregates of the period reports, and the reports made from them.

A partial table has, for every date and key, what the reports need to know of that
day's rows (null dates and keys are keys of their own):

* ``stations``, ``recipes``, ``drivers``, ``canteens`` – the reports' counts;
* ``usage``   – the earliest row of every batch of the day, with recipe and ingredients;
* ``batches`` – the different batch ids of the day;
* ``rows``    – row counts by kind.

All of them merge: rows of one date and key may come from several loads, and a
report sums (or picks again) over loads and days. So a month reads some rows a day
instead of all events, and a load adds its own partials without reading older ones.
Curated rows belong to one load each; a load that is written again replaces its own
partials (``streaming.loads``), so nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, LongType, StringType, StructField, StructType

from batchtrace import schemas
from batchtrace.functions.period import Period, as_period, first_rows
from batchtrace.operators import reports as R


def _counts(key: str, *counts: str) -> StructType:
    return StructType([StructField(key, StringType()), *(StructField(c, LongType()) for c in counts), StructField("event_date", DateType())])


PARTIAL_TABLES = {
    "stations": _counts("station_id", "total_times_active", "total_temp_warnings", "total_weight_warnings", "total_sensor_warnings"),
    "recipes": _counts("recipe_id", "total_times_cooked"),
    "drivers": _counts("driver_id", "total_deliveries", "total_truck_temp_warnings", "total_sensor_warnings"),
    "canteens": _counts("canteen_id", "total_deliveries"),
    "usage": StructType([StructField("batch_id", StringType()), StructField("recipe_id", StringType()),
                         StructField("ingredients", ArrayType(schemas.INGREDIENT)), StructField("event_timestamp", StringType()),
                         StructField("event_id", StringType()), StructField("event_date", DateType())]),
    "batches": _counts("batch_id"),
    "rows": _counts("kind", "n"),
}


def partials(k: DataFrame, d: DataFrame, q: DataFrame) -> dict[str, DataFrame]:
    """The partial tables of some curated kitchen, dispatch and dead-letter rows."""
    def counted(df: DataFrame, key: str, counts) -> DataFrame:
        return df.groupBy("event_date", key).agg(*counts())

    earliest = F.min_by(F.struct("recipe_id", "ingredients", "event_timestamp", "event_id"),
                        F.struct("event_timestamp", "event_id"))
    kinds = [df.groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
             for kind, df in (("kitchen", k), ("dispatch", d), ("dlq", q))]
    out = {
        "stations": counted(k, "station_id", R.station_counts),
        "recipes": counted(k, "recipe_id", R.recipe_counts),
        "drivers": counted(d, "driver_id", R.driver_counts),
        "canteens": counted(d, "canteen_id", R.canteen_counts),
        "usage": k.groupBy("event_date", "batch_id").agg(earliest.alias("_row")).select("event_date", "batch_id", "_row.*"),
        "batches": k.select("event_date", "batch_id").unionAll(d.select("event_date", "batch_id")).distinct(),
        "rows": kinds[0].unionByName(kinds[1]).unionByName(kinds[2]),
    }
    return {name: df.select(*PARTIAL_TABLES[name].fieldNames()) for name, df in out.items()}


def _merged(partial: DataFrame, key: str, period: Period | str, limit: int | None) -> DataFrame:
    """The counts of the period by key, over days and loads."""
    counts = [c for c in partial.columns if c not in (key, "event_date", "load")]
    kept = partial.filter(as_period(period).contains("event_date"))
    return first_rows(kept.groupBy(key).agg(*[F.sum(c).alias(c) for c in counts]).orderBy(key), limit)


def station_report(p: Mapping[str, DataFrame], period: Period | str, limit: int | None = None) -> DataFrame:
    return _merged(p["stations"], "station_id", period, limit)


def recipe_report(p: Mapping[str, DataFrame], period: Period | str, limit: int | None = None) -> DataFrame:
    return _merged(p["recipes"], "recipe_id", period, limit)


def driver_report(p: Mapping[str, DataFrame], period: Period | str, limit: int | None = None) -> DataFrame:
    return _merged(p["drivers"], "driver_id", period, limit)


def canteen_report(p: Mapping[str, DataFrame], period: Period | str, limit: int | None = None) -> DataFrame:
    return _merged(p["canteens"], "canteen_id", period, limit)


def ingredient_usage(p: Mapping[str, DataFrame], period: Period | str, limit: int | None = None) -> DataFrame:
    """The earliest of the days' earliest rows is the period's, so the report reads them as events."""
    return R.ingredient_usage(p["usage"], period, limit)


def batch_count(p: Mapping[str, DataFrame], period: Period | str) -> DataFrame:
    ids = p["batches"].filter(as_period(period).contains("event_date")).select("batch_id").distinct()
    return ids.agg(F.count(F.lit(1)).alias("total_batches"))


def row_counts(p: Mapping[str, DataFrame], period: Period | str) -> DataFrame:
    inside, undated = as_period(period).contains("event_date"), F.col("event_date").isNull()

    def of(kind: str, where) -> Column:
        return F.coalesce(F.sum(F.when((F.col("kind") == kind) & where, F.col("n"))), F.lit(0).cast("long"))

    return p["rows"].filter(inside | undated).agg(
        of("kitchen", inside).alias("kitchen_events"), of("dispatch", inside).alias("dispatch_events"),
        of("dlq", inside).alias("dlq_events"), of("dlq", undated).alias("dlq_undated_events"))

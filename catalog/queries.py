"""Named queries over the driver tables: Spark plan + DuckDB oracle text.

Fixed parameters: day 2024-01-05, month 2024-01, ingredient item_9, station
cook_01, batch BATCH-1229. Every query reads the whole ``events`` table (via
the fixture projection) so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchtrace.functions.period import Period
from batchtrace.operators import dlq as Q
from batchtrace.operators import reports as R
from batchtrace.operators.ingest import message_key, route
from catalog import oracle as O
from batchtrace.plans import rollups as P
from batchtrace.plans.curated import Curated
from catalog.fixture import load_raw_messages
from catalog.stores import curated_for, warehouse_for

DAY = Period.day("2024-01-05")
MONTH = Period.month("2024-01")
INGREDIENT = "item_9"
STATION = "cook_01"
BATCH = "BATCH-1229"

KITCHEN_FLAG_COLUMNS = (
    "event_id", "event_type", "source", "generated_at", "batch_id", "station_id", "recipe_id",
    "action", "weight_kg", "temperature_celsius", "event_timestamp", "expected_start_weight",
    "sensor_status", "temperature_status", "weight_status", "event_date",
)
DISPATCH_FLAG_COLUMNS = (
    "event_id", "event_type", "source", "generated_at", "batch_id", "canteen_id", "driver_id",
    "action", "truck_temp_celsius", "event_timestamp", "sensor_status", "temperature_status",
    "event_date",
)

QueryFn = Callable[[SparkSession, str], DataFrame]
SPARK: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _c(spark: SparkSession, sf_dir: str) -> Curated:
    return curated_for(spark, sf_dir)


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse_for(spark, sf_dir).routed_frame(spark)


# --- ingest: validation, routing, keys, raw archive -------------------------

@register("envelope_validation", O.with_ctes(
    'SELECT "key", topic, "timestamp", is_valid, route FROM routed'))
def q_envelope_validation(spark, sf_dir):
    return _routed(spark, sf_dir).select("key", "topic", "timestamp", "is_valid", "route")


@register("route_counts", O.with_ctes(
    "SELECT topic, route, count(*) AS n_messages FROM routed WHERE route IS NOT NULL GROUP BY topic, route"))
def q_route_counts(spark, sf_dir):
    return _routed(spark, sf_dir).groupBy("topic", "route").agg(F.count(F.lit(1)).alias("n_messages"))


@register("message_key", O.with_ctes(
    "SELECT topic, \"timestamp\", json_extract_string(\"value\", '$.metadata.event_id') AS message_key FROM raw"))
def q_message_key(spark, sf_dir):
    raw = load_raw_messages(spark, sf_dir)
    return raw.select("topic", "timestamp", message_key(F.col("value")).alias("message_key"))


@register("raw_archive", O.with_ctes(
    "SELECT \"key\" AS message_key, \"value\" AS raw_message, \"timestamp\" AS event_timestamp, "
    "CASE route WHEN 'clean_kitchen' THEN 'raw_kitchen' ELSE 'raw_dispatch' END AS archive "
    "FROM routed WHERE route IN ('clean_kitchen', 'clean_dispatch')"))
def q_raw_archive(spark, sf_dir):
    wh = warehouse_for(spark, sf_dir)
    return (wh.raw_archive(spark, "kitchen").withColumn("archive", F.lit("raw_kitchen"))
            .unionByName(wh.raw_archive(spark, "dispatch").withColumn("archive", F.lit("raw_dispatch"))))


def _malformed(raw: DataFrame) -> DataFrame:
    """Every message in one of seven damaged or merely odd forms, by its place."""
    v, form = F.col("value"), F.length("value") % 7
    damaged = (F.when(form == 0, F.concat(v, F.lit(" trailing")))
               .when(form == 1, F.concat(v, F.lit(","), v))
               .when(form == 2, F.translate(v, '"', "'"))
               .when(form == 3, F.concat(F.lit("  \n"), v, F.lit(" ")))
               .when(form == 4, F.replace(v, F.lit("data_"), F.lit("data\n")))
               .when(form == 5, F.concat(v, F.lit("]["), v))
               .otherwise(v))
    return raw.withColumns({"value": damaged, "form": form})


@register("envelope_validation_malformed", O.malformed(
    "SELECT topic, form, route, count(*) AS n_messages FROM routed GROUP BY topic, form, route"))
def q_envelope_validation_malformed(spark, sf_dir):
    """Strict validation of damaged messages (forms 3 and 6 stay valid where they were)."""
    return route(_malformed(load_raw_messages(spark, sf_dir))).groupBy("topic", "form", "route").agg(
        F.count(F.lit(1)).alias("n_messages"))


# --- curated tables ---------------------------------------------------------

@register("kitchen_flags", O.with_ctes(
    "SELECT " + ", ".join(KITCHEN_FLAG_COLUMNS) + " FROM kitchen"))
def q_kitchen_flags(spark, sf_dir):
    return _c(spark, sf_dir).kitchen.select(*KITCHEN_FLAG_COLUMNS)


@register("dispatch_flags", O.with_ctes(
    "SELECT " + ", ".join(DISPATCH_FLAG_COLUMNS) + " FROM dispatch"))
def q_dispatch_flags(spark, sf_dir):
    return _c(spark, sf_dir).dispatch.select(*DISPATCH_FLAG_COLUMNS)


@register("kitchen_listing_day", O.with_ctes(
    "SELECT " + ", ".join(R.KITCHEN_LISTING_COLUMNS) + f" FROM kitchen WHERE {O.in_day()}"))
def q_kitchen_listing_day(spark, sf_dir):
    return R.kitchen_listing(_c(spark, sf_dir).kitchen, DAY)


@register("dispatch_listing_day", O.with_ctes(
    "SELECT " + ", ".join(R.DISPATCH_LISTING_COLUMNS) + f" FROM dispatch WHERE {O.in_day()}"))
def q_dispatch_listing_day(spark, sf_dir):
    return R.dispatch_listing(_c(spark, sf_dir).dispatch, DAY)


# --- period reports ---------------------------------------------------------

def _station_sql(cond: str) -> str:
    return O.with_ctes(f"""
SELECT station_id,
  count(*) FILTER (WHERE action IN ('COOKING', 'PREPARING', 'PACKING')) AS total_times_active,
  count(*) FILTER (WHERE temperature_status <> 'OK') AS total_temp_warnings,
  count(*) FILTER (WHERE weight_status <> 'OK') AS total_weight_warnings,
  count(*) FILTER (WHERE sensor_status <> 'OK') AS total_sensor_warnings
FROM kitchen WHERE {cond} GROUP BY station_id""")


def _recipe_sql(cond: str) -> str:
    return O.with_ctes(f"""
SELECT recipe_id, count(*) FILTER (WHERE action = 'COOKING') AS total_times_cooked
FROM kitchen WHERE {cond} GROUP BY recipe_id""")


def _ingredient_sql(cond: str) -> str:
    return O.with_ctes(f"""
SELECT recipe_id, ing.item AS item, round(sum(ing.amount_kg), 2) AS total_weight_used
FROM (
  SELECT recipe_id, unnest(ingredients) AS ing
  FROM (
    SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY event_timestamp, event_id) AS rn
    FROM kitchen WHERE {cond})
  WHERE rn = 1)
GROUP BY recipe_id, ing.item""")


def _driver_sql(cond: str) -> str:
    return O.with_ctes(f"""
SELECT driver_id,
  count(*) FILTER (WHERE action = 'DELIVERED') AS total_deliveries,
  count(*) FILTER (WHERE temperature_status <> 'OK') AS total_truck_temp_warnings,
  count(*) FILTER (WHERE sensor_status <> 'OK') AS total_sensor_warnings
FROM dispatch WHERE {cond} GROUP BY driver_id""")


def _canteen_sql(cond: str) -> str:
    return O.with_ctes(f"""
SELECT canteen_id, count(*) FILTER (WHERE action = 'DELIVERED') AS total_deliveries
FROM dispatch WHERE {cond} GROUP BY canteen_id""")


def _batch_count_sql(cond: str) -> str:
    return O.with_ctes(f"""
SELECT count(*) AS total_batches FROM (
  SELECT DISTINCT batch_id FROM (
    SELECT batch_id FROM kitchen WHERE {cond}
    UNION ALL SELECT batch_id FROM dispatch WHERE {cond}))""")


def _row_counts_sql(cond: str) -> str:
    return O.with_ctes(f"""
SELECT
  (SELECT count(*) FROM kitchen WHERE {cond}) AS kitchen_events,
  (SELECT count(*) FROM dispatch WHERE {cond}) AS dispatch_events,
  (SELECT count(*) FROM dlq WHERE {cond}) AS dlq_events,
  (SELECT count(*) FROM dlq WHERE event_date IS NULL) AS dlq_undated_events""")


for _suffix, _period, _cond in (("day", DAY, O.in_day()), ("month", MONTH, O.in_month())):
    def _make(p):
        return {
            "station_report": lambda spark, sf: R.station_report(_c(spark, sf).kitchen, p),
            "recipe_report": lambda spark, sf: R.recipe_report(_c(spark, sf).kitchen, p),
            "ingredient_usage": lambda spark, sf: R.ingredient_usage(_c(spark, sf).kitchen, p),
            "driver_report": lambda spark, sf: R.driver_report(_c(spark, sf).dispatch, p),
            "canteen_report": lambda spark, sf: R.canteen_report(_c(spark, sf).dispatch, p),
            "batch_count": lambda spark, sf: (lambda c: R.batch_count(c.kitchen, c.dispatch, p))(_c(spark, sf)),
            "row_counts": lambda spark, sf: (lambda c: R.row_counts(c.kitchen, c.dispatch, c.dlq, p))(_c(spark, sf)),
        }
    _sqls = {
        "station_report": _station_sql(_cond), "recipe_report": _recipe_sql(_cond),
        "ingredient_usage": _ingredient_sql(_cond), "driver_report": _driver_sql(_cond),
        "canteen_report": _canteen_sql(_cond), "batch_count": _batch_count_sql(_cond),
        "row_counts": _row_counts_sql(_cond),
    }
    for _name, _fn in _make(_period).items():
        register(f"{_name}_{_suffix}", _sqls[_name])(_fn)


# Monthly reports from the stored per-day partials.
for _name, _report in (("station_report", P.station_report), ("recipe_report", P.recipe_report), ("driver_report", P.driver_report),
                       ("canteen_report", P.canteen_report), ("ingredient_usage", P.ingredient_usage),
                       ("batch_count", P.batch_count), ("row_counts", P.row_counts)):
    register(f"{_name}_month_from_days", SQL[f"{_name}_month"])(
        lambda spark, sf, report=_report: report(warehouse_for(spark, sf).rollups(spark), MONTH))


# --- dead letters -----------------------------------------------------------

_DLQ_COLS = ", ".join(Q.DLQ_REPORT_COLUMNS)


@register("dlq_report_day", O.with_ctes(f"SELECT {_DLQ_COLS} FROM dlq WHERE {O.in_day()}"))
def q_dlq_report_day(spark, sf_dir):
    return Q.dlq_report(_c(spark, sf_dir).dlq, DAY)


@register("dlq_report_month", O.with_ctes(f"SELECT {_DLQ_COLS} FROM dlq WHERE {O.in_month()}"))
def q_dlq_report_month(spark, sf_dir):
    return Q.dlq_report(_c(spark, sf_dir).dlq, MONTH)


@register("dlq_report_undated", O.with_ctes(f"SELECT {_DLQ_COLS} FROM dlq WHERE event_date IS NULL"))
def q_dlq_report_undated(spark, sf_dir):
    return Q.dlq_undated(_c(spark, sf_dir).dlq)


@register("dlq_reason_counts", O.with_ctes(
    "SELECT error_reason, count(*) AS n_messages FROM dlq GROUP BY error_reason"))
def q_dlq_reason_counts(spark, sf_dir):
    return Q.dlq_reason_counts(_c(spark, sf_dir).dlq)


@lru_cache(maxsize=1)
def all_queries() -> tuple[dict[str, QueryFn], dict[str, str]]:
    # Importing the other query modules registers their entries.
    from catalog import queries_more  # noqa: F401
    from catalog import queries_io  # noqa: F401
    return dict(SPARK), dict(SQL)

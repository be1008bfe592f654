"""Journey, league table and graph queries (registered on import)."""

from __future__ import annotations

from pyspark.sql import functions as F

from batchtrace.operators import graph as G
from batchtrace.operators import journey as J
from catalog import oracle as O
from batchtrace.plans.warehouse import Warehouse, merge_graph
from batchtrace.session import scratch_path
from catalog.queries import BATCH, DAY, INGREDIENT, SQL, STATION, _c, register
from catalog.stores import HOME_DAYS, graph_for, warehouse_for

# --- journey and league table -------------------------------------------------

_JOURNEY_SQL = O.with_ctes(f"""
SELECT batch_id, event_id, event_timestamp, 'Kitchen' AS source, action,
       'Station ' || COALESCE(station_id, 'None') AS location,
       station_id, CAST(NULL AS VARCHAR) AS driver_id, CAST(NULL AS VARCHAR) AS canteen_id
FROM kitchen WHERE batch_id = '{BATCH}'
UNION ALL
SELECT batch_id, event_id, event_timestamp, 'Dispatch' AS source, action,
       'Driver ' || COALESCE(driver_id, 'None') AS location,
       CAST(NULL AS VARCHAR) AS station_id, driver_id, canteen_id
FROM dispatch WHERE batch_id = '{BATCH}'""")


@register("batch_journey", _JOURNEY_SQL)
def q_batch_journey(spark, sf_dir):
    wh = warehouse_for(spark, sf_dir)
    c = wh.curated(spark)
    return J.batch_journey(c.kitchen, c.dispatch, BATCH, wh.batch_index(spark))


@register("batch_exists", O.with_ctes(f"""
SELECT '{BATCH}' AS batch_id, k > 0 AS in_kitchen, d > 0 AS in_dispatch, (k + d) > 0 AS found
FROM (SELECT (SELECT count(*) FROM kitchen WHERE batch_id = '{BATCH}') AS k,
             (SELECT count(*) FROM dispatch WHERE batch_id = '{BATCH}') AS d)"""))
def q_batch_exists(spark, sf_dir):
    return J.indexed_batch_exists(warehouse_for(spark, sf_dir).batch_index(spark), BATCH)


_SPANS_CTE = """
spans AS (
  SELECT * FROM (
    SELECT batch_id, driver_id, start_time, end_time,
           date_diff('minute', TRY_CAST(start_time AS TIMESTAMP), TRY_CAST(end_time AS TIMESTAMP)) AS delivery_time_mins
    FROM (SELECT batch_id, driver_id, min(event_timestamp) AS start_time, max(event_timestamp) AS end_time
          FROM dispatch WHERE action IN ('LOADING', 'DELIVERED') GROUP BY batch_id, driver_id))
  WHERE delivery_time_mins > 0
)"""


@register("delivery_spans", O.with_ctes("SELECT * FROM spans", _SPANS_CTE))
def q_delivery_spans(spark, sf_dir):
    return J.delivery_spans(_c(spark, sf_dir).dispatch)


@register("driver_leaderboard", O.with_ctes("""
SELECT row_number() OVER (ORDER BY avg_time, driver_id NULLS FIRST) AS rank,
       driver_id, min_time, max_time, avg_time, total_deliveries
FROM (SELECT driver_id, min(delivery_time_mins) AS min_time, max(delivery_time_mins) AS max_time,
             avg(delivery_time_mins) AS avg_time, count(*) AS total_deliveries
      FROM spans GROUP BY driver_id)""", _SPANS_CTE))
def q_driver_leaderboard(spark, sf_dir):
    return J.driver_leaderboard(_c(spark, sf_dir).dispatch)


# --- graph tables -------------------------------------------------------------

_GRAPH_CTES = """
g_processed AS (
  SELECT src, dst, action, "time", temp_celsius, weight, event_id FROM (
    SELECT station_id AS src, batch_id AS dst, action, event_timestamp AS "time",
           temperature_celsius AS temp_celsius, weight_kg AS weight, event_id,
           row_number() OVER (PARTITION BY station_id, batch_id
                              ORDER BY event_timestamp DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
    FROM kitchen WHERE station_id IS NOT NULL AND batch_id IS NOT NULL)
  WHERE rn = 1
),
g_delivers AS (
  SELECT src, dst, action, "time", truck_temp_celsius, event_id FROM (
    SELECT driver_id AS src, batch_id AS dst, action, event_timestamp AS "time", truck_temp_celsius, event_id,
           row_number() OVER (PARTITION BY driver_id, batch_id
                              ORDER BY event_timestamp DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
    FROM dispatch WHERE driver_id IS NOT NULL AND batch_id IS NOT NULL)
  WHERE rn = 1
),
g_ingredients AS (
  SELECT recipe_id, u.item AS item FROM (SELECT recipe_id, unnest(ingredients) AS u FROM kitchen)
),
g_uses_recipe AS (
  SELECT DISTINCT batch_id AS src, recipe_id AS dst FROM kitchen WHERE batch_id IS NOT NULL AND recipe_id IS NOT NULL
),
g_requires AS (
  SELECT DISTINCT recipe_id AS src, item AS dst FROM g_ingredients WHERE recipe_id IS NOT NULL AND item IS NOT NULL
),
g_destined_for AS (
  SELECT DISTINCT batch_id AS src, canteen_id AS dst FROM dispatch WHERE batch_id IS NOT NULL AND canteen_id IS NOT NULL
)"""


def _g(select: str) -> str:
    return O.with_ctes(select, _GRAPH_CTES)


@register("graph_nodes", _g("""
SELECT DISTINCT label, id FROM (
  SELECT 'Batch' AS label, batch_id AS id FROM kitchen
  UNION ALL SELECT 'Station', station_id FROM kitchen
  UNION ALL SELECT 'Recipe', recipe_id FROM kitchen
  UNION ALL SELECT 'Ingredient', item FROM g_ingredients
  UNION ALL SELECT 'Batch', batch_id FROM dispatch
  UNION ALL SELECT 'Driver', driver_id FROM dispatch
  UNION ALL SELECT 'Canteen', canteen_id FROM dispatch)
WHERE id IS NOT NULL"""))
def q_graph_nodes(spark, sf_dir):
    c = _c(spark, sf_dir)
    return G.build_nodes(c.kitchen, c.dispatch)


def _edge_query(rel: str):
    def fn(spark, sf_dir):
        c = _c(spark, sf_dir)
        return getattr(G.build_edges(c.kitchen, c.dispatch), rel).drop("event_day")
    return fn


for _rel in ("processed", "delivers", "uses_recipe", "requires", "destined_for"):
    register(f"graph_{_rel}", _g(f"SELECT * FROM g_{_rel}"))(_edge_query(_rel))


_SPLIT_DAY = "2024-01-16"


@register("graph_upsert", _g("""
SELECT 'PROCESSED' AS rel, src, dst, action, "time", event_id FROM g_processed
UNION ALL
SELECT 'DELIVERS' AS rel, src, dst, action, "time", event_id FROM g_delivers"""))
def q_graph_upsert(spark, sf_dir):
    """Load the first half of the month, then upsert the rest (and the first
    half again): the result equals one full load."""
    c = _c(spark, sf_dir)
    early = F.col("event_date") < F.lit(_SPLIT_DAY).cast("date")
    first = G.build_edges(c.kitchen.filter(early), c.dispatch.filter(early))
    rest = G.build_edges(c.kitchen.filter(~F.coalesce(early, F.lit(False))),
                         c.dispatch.filter(~F.coalesce(early, F.lit(False))))
    merged = G.upsert_edges(G.upsert_edges(first, rest), first)
    cols = ["src", "dst", "action", "time", "event_id"]
    return (merged.processed.select(F.lit("PROCESSED").alias("rel"), *cols)
            .unionByName(merged.delivers.select(F.lit("DELIVERS").alias("rel"), *cols)))


def _merged_graph(spark, sf_dir):
    """A stored graph of the first half of the month, then two merges into it:
    the rest, and the first half again (which must change nothing)."""
    c = _c(spark, sf_dir)
    early = F.coalesce(F.col("event_date") < F.lit(_SPLIT_DAY).cast("date"), F.lit(False))
    wh = Warehouse(scratch_path(spark, "graph-merge"), HOME_DAYS)
    for part in (early, ~early, early):
        merge_graph(spark, wh, c.kitchen.filter(part), c.dispatch.filter(part))
    return wh


@register("graph_upsert_stored", _g("""
SELECT 'PROCESSED' AS rel, src, dst, action, "time", event_id FROM g_processed
UNION ALL SELECT 'DELIVERS', src, dst, action, "time", event_id FROM g_delivers
UNION ALL SELECT 'USES_RECIPE', src, dst, NULL, NULL, NULL FROM g_uses_recipe
UNION ALL SELECT 'REQUIRES', src, dst, NULL, NULL, NULL FROM g_requires
UNION ALL SELECT 'DESTINED_FOR', src, dst, NULL, NULL, NULL FROM g_destined_for"""))
def q_graph_upsert_stored(spark, sf_dir):
    out = None
    for rel, df in _merged_graph(spark, sf_dir).graph_edges(spark).as_dict().items():
        texts = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ("action", "time", "event_id")]
        part = df.select(F.lit(rel.upper()).alias("rel"), "src", "dst", *texts)
        out = part if out is None else out.unionByName(part)
    return out


@register("graph_nodes_stored", SQL["graph_nodes"])
def q_graph_nodes_stored(spark, sf_dir):
    return _merged_graph(spark, sf_dir).graph_nodes(spark)


# --- path queries ---------------------------------------------------------------

@register("ingredient_recall", _g(f"""
SELECT DISTINCT rq.dst AS target_ingredient, u.dst AS recipe_used, u.src AS batch_id, dd.dst AS affected_canteen
FROM g_requires rq
JOIN g_uses_recipe u ON u.dst = rq.src
JOIN g_destined_for dd ON dd.src = u.src
WHERE rq.dst = '{INGREDIENT}'
  AND EXISTS (SELECT 1 FROM g_processed p WHERE p.dst = u.src AND starts_with(p."time", '{DAY.label}'))"""))
def q_ingredient_recall(spark, sf_dir):
    return G.ingredient_recall(graph_for(spark, sf_dir), INGREDIENT, DAY)


@register("contamination_risk", _g(f"""
SELECT l.risk_station, l.shared_batch,
       CASE WHEN len(l.later) > 0 THEN array_to_string(l.later, ', ') ELSE 'None' END AS later_stations,
       len(l.later) AS n_later_stations,
       dv.src AS exposed_driver, dd.dst AS affected_canteen
FROM (
  SELECT p1.src AS risk_station, p1.dst AS shared_batch,
         list_sort(list_filter(list(DISTINCT p2.src), lambda x: x IS NOT NULL)) AS later
  FROM (SELECT * FROM g_processed WHERE src = '{STATION}' AND starts_with("time", '{DAY.label}')) p1
  LEFT JOIN g_processed p2 ON p2.dst = p1.dst AND p2."time" > p1."time"
  GROUP BY p1.src, p1.dst) l
JOIN g_delivers dv ON dv.dst = l.shared_batch
JOIN g_destined_for dd ON dd.src = l.shared_batch"""))
def q_contamination_risk(spark, sf_dir):
    return G.contamination_risk(graph_for(spark, sf_dir), STATION, DAY)

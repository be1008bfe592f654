"""DuckDB oracle texts.

Each query is a self-contained SQL text over the registered driver tables.
The fixture projection is inlined as CTEs, and the operator logic is written
independently of the Spark code, with DuckDB's JSON functions
(``json_type``, ``json_exists``, ``json_extract_string``), list functions and
``date_diff``.
"""

from __future__ import annotations

# Raw messages from the events table: key, value, topic, timestamp.
_FIXTURE = r"""
fx_base AS (
  SELECT event_id AS i, ts, event_type, props, CAST(floor(coalesce(value, 0)) AS BIGINT) AS v,
    CASE WHEN user_id % 10 = 0 THEN 228 ELSE event_id // 6 END AS b, event_id % 6 AS k FROM events
),
fx_vals AS (
  SELECT i, ts, b, k, event_type, props,
    1000 + (b * 737 + v) % 4001 AS w0,
    b % 4 AS r,
    CASE WHEN i % 19 = 11 THEN (i // 19) % 7 ELSE -1 END AS bad,
    CASE i % 97 WHEN 1 THEN '2023-12-31T23:59' WHEN 2 THEN '2024-01-01T00:00'
                WHEN 3 THEN '2024-01-31T23:59' WHEN 4 THEN '2024-02-01T00:00'
      ELSE strftime(ts + (CAST(k * 20 + (i * 7) % 10 AS INTEGER) * INTERVAL '1 minute')
             + (CASE WHEN i % 31 = 9 THEN 35 ELSE 0 END * INTERVAL '1 day'), '%Y-%m-%dT%H:%M') END AS ets,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS gen,
    CASE WHEN i % 17 = 3 THEN NULL
         WHEN (b * 31 + k) % 11 = 0 THEN 1000 + (b * 737 + v) % 4001 - 350
         ELSE 1000 + (b * 737 + v) % 4001 - 30 * k END AS w,
    CASE WHEN i % 23 = 5 THEN NULL
         WHEN k = 0 THEN 150 + (i * 13) % 70
         WHEN k = 1 THEN CASE WHEN b % 10 = 4 THEN 500 + (i * 17) % 240 ELSE 750 + (i * 17) % 250 END
         WHEN k = 2 THEN 400 + (i * 11) % 200
         ELSE CASE WHEN b % 10 = 7 THEN 60 + (i * 7) % 90 ELSE (i * 7) % 230 - 180 END END AS t
  FROM fx_base
),
fx_text AS (
  SELECT *,
    CASE WHEN k < 3 THEN 'KIT-' ELSE 'DIS-' END || CAST(i AS VARCHAR) AS eid,
    CASE WHEN i % 41 = 7 THEN 'null' ELSE '"BATCH-' || CAST(b + 1001 AS VARCHAR) || '"' END AS bid,
    CASE k WHEN 0 THEN 'PREPARING' WHEN 1 THEN 'COOKING' WHEN 2 THEN 'PACKING'
           WHEN 3 THEN 'LOADING' WHEN 4 THEN 'DELIVERY' ELSE 'DELIVERED' END AS act,
    CASE WHEN w IS NULL THEN 'null' ELSE
      CAST(w // 100 AS VARCHAR) || '.' || lpad(CAST(w % 100 AS VARCHAR), 2, '0') END AS w_txt,
    CASE WHEN t IS NULL THEN 'null' ELSE
      (CASE WHEN t < 0 THEN '-' ELSE '' END) || CAST(abs(t) // 10 AS VARCHAR) || '.'
      || CAST(abs(t) % 10 AS VARCHAR) END AS t_txt,
    (w0 * 5 + 5) // 10 AS a1, (w0 * 3 + 5) // 10 AS a2, (w0 * 2 + 5) // 10 AS a3
  FROM fx_vals
),
fx_json AS (
  SELECT *,
    '{' || concat_ws(', ',
      CASE WHEN bad <> 3 THEN '"event_id": "' || eid || '"' END,
      CASE WHEN bad <> 5 THEN '"event_type": "' || CASE WHEN k < 3 THEN 'kitchen_action' ELSE 'dispatch_action' END || '"' END,
      '"source": "data_generator/' || event_type || '"',
      '"generated_at": "' || gen || '"') || '}' AS meta_txt,
    CASE WHEN k < 3 THEN
      '{' || concat_ws(', ',
        CASE WHEN bad <> 4 THEN '"batch_id": ' || bid END,
        '"station_id": "' || CASE k WHEN 0 THEN 'prep_0' || CAST(1 + b % 4 AS VARCHAR)
                                    WHEN 1 THEN 'cook_0' || CAST(1 + b % 6 AS VARCHAR)
                                    ELSE 'pack_0' || CAST(1 + b % 4 AS VARCHAR) END || '"',
        '"recipe_id": "recipe_' || CAST(r AS VARCHAR) || '"',
        CASE WHEN bad <> 6 THEN '"action": "' || act || '"' END,
        '"weight_kg": ' || w_txt,
        '"ingredients": [' ||
          '{"item": "item_' || CAST(2 * r AS VARCHAR) || '", "amount_kg": ' || CAST(a1 // 100 AS VARCHAR) || '.' || lpad(CAST(a1 % 100 AS VARCHAR), 2, '0') || '}, ' ||
          '{"item": "item_' || CAST(2 * r + 1 AS VARCHAR) || '", "amount_kg": ' || CAST(a2 // 100 AS VARCHAR) || '.' || lpad(CAST(a2 % 100 AS VARCHAR), 2, '0') || '}, ' ||
          '{"item": "' || CASE WHEN r % 2 = 0 THEN 'item_9' ELSE 'item_8' END || '", "amount_kg": ' || CAST(a3 // 100 AS VARCHAR) || '.' || lpad(CAST(a3 % 100 AS VARCHAR), 2, '0') || '}]',
        '"temperature_celsius": ' || t_txt,
        '"event_timestamp": "' || ets || '"',
        '"props": ' || props) || '}'
    ELSE
      '{' || concat_ws(', ',
        CASE WHEN bad <> 4 THEN '"batch_id": ' || bid END,
        '"canteen_id": "cant_0' || CAST(1 + b % 5 AS VARCHAR) || '"',
        '"driver_id": "drv_0' || CAST(1 + b % 7 AS VARCHAR) || '"',
        CASE WHEN bad <> 6 THEN '"action": "' || act || '"' END,
        '"truck_temp_celsius": ' || t_txt,
        '"event_timestamp": "' || ets || '"',
        '"props": ' || props) || '}'
    END AS payload_txt
  FROM fx_text
),
raw AS (
  SELECT
    CASE WHEN bad IN (0, 1, 3) THEN NULL ELSE eid END AS "key",
    CASE WHEN bad = 0 THEN '"CORRUPT_TEXT"'
         ELSE '{' || concat_ws(', ',
                CASE WHEN bad <> 1 THEN '"metadata": ' || meta_txt END,
                CASE WHEN bad <> 2 THEN '"payload": ' || payload_txt END) || '}' END AS "value",
    CASE WHEN event_type = 'error' AND i % 29 = 3 THEN 'audit_events'
         WHEN k < 3 THEN 'kitchen_station_events' ELSE 'dispatch_events' END AS topic,
    ts AS "timestamp"
  FROM fx_json
)"""

# Validation, routing, parse, flags, dates.
_CURATED = r"""
checked AS (
  SELECT *,
    CASE WHEN NOT coalesce(json_valid("value"), false) THEN false ELSE
      COALESCE(json_type("value") = 'OBJECT'
        AND json_type("value", '$.metadata') = 'OBJECT'
        AND json_type("value", '$.payload') = 'OBJECT'
        AND json_exists("value", '$.metadata.event_id')
        AND json_exists("value", '$.metadata.event_type')
        AND json_exists("value", '$.payload.batch_id')
        AND json_exists("value", '$.payload.action'), false) END AS is_valid
  FROM raw WHERE topic IN ('kitchen_station_events', 'dispatch_events')
),
routed AS (
  SELECT *,
    CASE WHEN topic NOT IN ('kitchen_station_events', 'dispatch_events') OR topic IS NULL THEN NULL
         WHEN NOT is_valid THEN 'dlq'
         WHEN topic = 'kitchen_station_events' THEN 'clean_kitchen'
         ELSE 'clean_dispatch' END AS route
  FROM checked
),
k_parsed AS (
  SELECT
    json_extract_string("value", '$.metadata.event_id') AS event_id,
    json_extract_string("value", '$.metadata.event_type') AS event_type,
    json_extract_string("value", '$.metadata.source') AS source,
    json_extract_string("value", '$.metadata.generated_at') AS generated_at,
    json_extract_string("value", '$.payload.batch_id') AS batch_id,
    json_extract_string("value", '$.payload.station_id') AS station_id,
    json_extract_string("value", '$.payload.recipe_id') AS recipe_id,
    json_extract_string("value", '$.payload.action') AS action,
    TRY_CAST(json_extract_string("value", '$.payload.weight_kg') AS DOUBLE) AS weight_kg,
    CAST(json_extract("value", '$.payload.ingredients') AS STRUCT(item VARCHAR, amount_kg DOUBLE)[]) AS ingredients,
    TRY_CAST(json_extract_string("value", '$.payload.temperature_celsius') AS DOUBLE) AS temperature_celsius,
    json_extract_string("value", '$.payload.event_timestamp') AS event_timestamp
  FROM routed WHERE route = 'clean_kitchen'
),
kitchen AS (
  SELECT *,
    CASE WHEN weight_kg IS NULL OR temperature_celsius IS NULL THEN 'SENSOR_FAILURE' ELSE 'OK' END AS sensor_status,
    CASE WHEN action = 'COOKING' AND temperature_celsius < 75.0 THEN 'LOW_HEAT_WARNING' ELSE 'OK' END AS temperature_status,
    CASE WHEN weight_kg IS NULL THEN 'UNKNOWN'
         WHEN action IN ('PREPARING', 'COOKING', 'PACKING') AND expected_start_weight - weight_kg >= 2.0 THEN 'SUSPICIOUS_DROP'
         ELSE 'OK' END AS weight_status,
    TRY_CAST(substr(event_timestamp, 1, 10) AS DATE) AS event_date
  FROM (
    SELECT *,
      CASE WHEN ingredients IS NULL THEN NULL
           WHEN len(ingredients) = 0 THEN 0.0
           WHEN list_bool_or(list_transform(ingredients, lambda x: x.amount_kg IS NULL)) THEN NULL
           ELSE round(list_reduce(list_transform(ingredients, lambda x: x.amount_kg), lambda a, c: a + c), 2) END
        AS expected_start_weight
    FROM k_parsed)
),
dispatch AS (
  SELECT *,
    CASE WHEN truck_temp_celsius IS NULL THEN 'SENSOR_FAILURE' ELSE 'OK' END AS sensor_status,
    CASE WHEN truck_temp_celsius > 5.0 THEN 'WARM_TRUCK_WARNING' ELSE 'OK' END AS temperature_status,
    TRY_CAST(substr(event_timestamp, 1, 10) AS DATE) AS event_date
  FROM (
    SELECT
      json_extract_string("value", '$.metadata.event_id') AS event_id,
      json_extract_string("value", '$.metadata.event_type') AS event_type,
      json_extract_string("value", '$.metadata.source') AS source,
      json_extract_string("value", '$.metadata.generated_at') AS generated_at,
      json_extract_string("value", '$.payload.batch_id') AS batch_id,
      json_extract_string("value", '$.payload.canteen_id') AS canteen_id,
      json_extract_string("value", '$.payload.driver_id') AS driver_id,
      json_extract_string("value", '$.payload.action') AS action,
      TRY_CAST(json_extract_string("value", '$.payload.truck_temp_celsius') AS DOUBLE) AS truck_temp_celsius,
      json_extract_string("value", '$.payload.event_timestamp') AS event_timestamp
    FROM routed WHERE route = 'clean_dispatch')
),
dlq AS (
  SELECT *, TRY_CAST(substr(payload_timestamp, 1, 10) AS DATE) AS event_date
  FROM (
    SELECT "key" AS message_key, "value" AS raw_message, "timestamp" AS event_timestamp,
      json_extract_string("value", '$.payload.event_timestamp') AS payload_timestamp,
      json_extract_string("value", '$.metadata.event_id') AS event_id,
      json_extract_string("value", '$.payload.batch_id') AS batch_id,
      CASE WHEN NOT starts_with(ltrim("value"), '{') THEN 'Invalid JSON String'
           WHEN json_extract_string("value", '$.metadata') IS NULL THEN 'Missing Metadata'
           WHEN json_extract_string("value", '$.metadata.event_id') IS NULL THEN 'Missing Event ID'
           WHEN json_extract_string("value", '$.metadata.event_type') IS NULL THEN 'Missing Event Type'
           WHEN json_extract_string("value", '$.payload') IS NULL THEN 'Missing Payload'
           WHEN json_extract_string("value", '$.payload.batch_id') IS NULL THEN 'Missing Batch ID'
           WHEN json_extract_string("value", '$.payload.action') IS NULL THEN 'Missing Batch Action'
           ELSE 'Others' END AS error_reason
    FROM routed WHERE route = 'dlq')
)"""

_DAY = "DATE '2024-01-05'"
_MONTH_START, _MONTH_END = "DATE '2024-01-01'", "DATE '2024-02-01'"


def with_ctes(select: str, extra: str = "") -> str:
    ctes = _FIXTURE + "," + _CURATED + ("," + extra if extra else "")
    return "WITH " + ctes + "\n" + select


def in_day(col: str = "event_date") -> str:
    return f"{col} = {_DAY}"


def in_month(col: str = "event_date") -> str:
    return f"{col} >= {_MONTH_START} AND {col} < {_MONTH_END}"


_DAMAGED = r"""
damaged AS (
  SELECT "key", topic, "timestamp", length("value")::INT % 7 AS form,
    CASE length("value") % 7
      WHEN 0 THEN "value" || ' trailing'
      WHEN 1 THEN "value" || ',' || "value"
      WHEN 2 THEN translate("value", '"', '''')
      WHEN 3 THEN '  ' || chr(10) || "value" || ' '
      WHEN 4 THEN replace("value", 'data_', 'data' || chr(10))
      WHEN 5 THEN "value" || '][' || "value"
      ELSE "value" END AS "value"
  FROM raw)"""


def malformed(select: str) -> str:
    """``select`` over the routed form of damaged messages."""
    checked = _CURATED[:_CURATED.index("k_parsed AS")].replace("FROM raw WHERE", "FROM damaged WHERE").rstrip().rstrip(",")
    return "WITH " + _FIXTURE + "," + _DAMAGED + "," + checked + "\n" + select

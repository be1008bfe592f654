"""Business-rule flags on parsed kitchen and dispatch rows (per-row, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchtrace import config as C


def expected_start_weight(ingredients: Column) -> Column:
    """Sum of ingredient amounts, rounded to 2 places (half up).

    Null if the array or any amount is null; 0.0 for an empty array.
    """
    total = F.aggregate(ingredients, F.lit(0.0).cast("double"),
                        lambda acc, x: acc + x.getField("amount_kg"))
    return F.round(total, 2)


def event_date(ts_text: Column) -> Column:
    """Calendar date of the first ten characters of a timestamp text; null if
    they are not a ``yyyy-MM-dd`` date."""
    return F.try_to_date(F.substring(ts_text.cast("string"), 1, 10), "yyyy-MM-dd")


def with_event_date(df: DataFrame, source: str = "event_timestamp") -> DataFrame:
    return df.withColumn("event_date", event_date(F.col(source)))


def kitchen_rules(flat: DataFrame, thresholds: C.Thresholds = C.Thresholds()) -> DataFrame:
    """Flags on parsed kitchen rows.

    * sensor_status: SENSOR_FAILURE if weight or temperature is null.
    * temperature_status: LOW_HEAT_WARNING if COOKING and temp < min (strict);
      a null temperature is OK.
    * weight_status: UNKNOWN if weight is null; SUSPICIOUS_DROP for a kitchen
      action whose expected - weight >= min drop (inclusive); else OK.
    """
    weight, temp, action = F.col("weight_kg"), F.col("temperature_celsius"), F.col("action")
    expected = F.col("expected_start_weight")
    return (
        flat.withColumn("expected_start_weight", expected_start_weight(F.col("ingredients")))
        .withColumn("sensor_status",
                    F.when(weight.isNull() | temp.isNull(), F.lit(C.SENSOR_FAILURE)).otherwise(F.lit(C.OK)))
        .withColumn("temperature_status",
                    F.when((action == C.COOKING) & (temp < F.lit(thresholds.min_cook_temp)),
                           F.lit(C.LOW_HEAT_WARNING)).otherwise(F.lit(C.OK)))
        .withColumn("weight_status",
                    F.when(weight.isNull(), F.lit(C.UNKNOWN))
                    .when(action.isin(*C.KITCHEN_ACTIONS)
                          & ((expected - weight) >= F.lit(thresholds.min_weight_drop)),
                          F.lit(C.SUSPICIOUS_DROP))
                    .otherwise(F.lit(C.OK)))
    )


def dispatch_rules(flat: DataFrame, thresholds: C.Thresholds = C.Thresholds()) -> DataFrame:
    """Flags on parsed dispatch rows.

    * sensor_status: SENSOR_FAILURE if truck temperature is null.
    * temperature_status: WARM_TRUCK_WARNING if truck temp > max (strict).
    """
    temp = F.col("truck_temp_celsius")
    return (
        flat.withColumn("sensor_status",
                        F.when(temp.isNull(), F.lit(C.SENSOR_FAILURE)).otherwise(F.lit(C.OK)))
        .withColumn("temperature_status",
                    F.when(temp > F.lit(thresholds.max_truck_temp), F.lit(C.WARM_TRUCK_WARNING))
                    .otherwise(F.lit(C.OK)))
    )

"""Dead-letter classification and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchtrace import config as C
from batchtrace.functions.period import Period, as_period, first_rows
from batchtrace.operators.rules import event_date

DLQ_REPORT_COLUMNS = ("payload_timestamp", "event_id", "batch_id", "error_reason")


def classify_dlq(archive: DataFrame, raw_col: str = "raw_message") -> DataFrame:
    """Dead-letter rows plus ``payload_timestamp, event_id, batch_id,
    error_reason, event_date``.

    The reason is the first failing check: text not starting with ``{`` →
    invalid JSON; then missing (or null) metadata, event id, event type,
    payload, batch id, action; else Others. White space before the ``{`` does
    not count (the source system re-serialises before it looks). The text is
    parsed once for its two members and each member once for its fields.
    """
    raw = F.col(raw_col)
    with_paths = (archive
                  .select("*", F.json_tuple(raw, "metadata", "payload").alias("_meta", "_payload"))
                  .select("*", F.json_tuple("_meta", "event_id", "event_type").alias("event_id", "_evt_type"))
                  .select("*", F.json_tuple("_payload", "event_timestamp", "batch_id", "action")
                          .alias("payload_timestamp", "batch_id", "_action")))
    reason = (
        F.when(~F.coalesce(F.ltrim(raw, F.lit(" \t\r\n")).startswith("{"), F.lit(False)), F.lit(C.DLQ_INVALID_JSON))
        .when(F.col("_meta").isNull(), F.lit(C.DLQ_MISSING_METADATA))
        .when(F.col("event_id").isNull(), F.lit(C.DLQ_MISSING_EVENT_ID))
        .when(F.col("_evt_type").isNull(), F.lit(C.DLQ_MISSING_EVENT_TYPE))
        .when(F.col("_payload").isNull(), F.lit(C.DLQ_MISSING_PAYLOAD))
        .when(F.col("batch_id").isNull(), F.lit(C.DLQ_MISSING_BATCH_ID))
        .when(F.col("_action").isNull(), F.lit(C.DLQ_MISSING_ACTION))
        .otherwise(F.lit(C.DLQ_OTHERS))
    )
    return (with_paths
            .withColumn("error_reason", reason)
            .withColumn("event_date", event_date(F.col("payload_timestamp")))
            .drop("_meta", "_evt_type", "_payload", "_action"))


def dated_in(q: DataFrame, period: Period | str) -> DataFrame:
    """Dead letters dated in the period, in no order (cheap to test for rows)."""
    return q.filter(as_period(period).contains("event_date")).select(*DLQ_REPORT_COLUMNS)


def undated(q: DataFrame) -> DataFrame:
    """Dead letters whose payload carries no usable date, in no order."""
    return q.filter(F.col("event_date").isNull()).select(*DLQ_REPORT_COLUMNS)


def _by_time(rows: DataFrame, limit: int | None) -> DataFrame:
    return first_rows(rows.orderBy(F.col("payload_timestamp").asc_nulls_first(), "event_id"), limit)


def dlq_report(q: DataFrame, period: Period | str, limit: int | None = None) -> DataFrame:
    """Dead letters dated in the period, ordered by payload timestamp."""
    return _by_time(dated_in(q, period), limit)


def dlq_undated(q: DataFrame, limit: int | None = None) -> DataFrame:
    """Dead letters whose payload carries no usable date."""
    return _by_time(undated(q), limit)


def dlq_reason_counts(q: DataFrame) -> DataFrame:
    """Dead letters per reason (map-side combined count)."""
    return (q.groupBy("error_reason").agg(F.count(F.lit(1)).alias("n_messages"))
            .orderBy("error_reason"))

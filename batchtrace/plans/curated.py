"""Curated frames from raw topic messages (the batch form of the pipeline).

``raw → route → {clean kitchen, clean dispatch, dlq}`` then parse + flags.
Everything is narrow (no shuffle). The streaming pipeline applies the same
functions to stream frames and stores the results partitioned by
``event_date``; :func:`load_curated` reads such stored tables back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchtrace import config as C
from batchtrace import schemas
from batchtrace.operators.dlq import classify_dlq
from batchtrace.operators.ingest import decode_raw, parse_envelope, route
from batchtrace.operators.rules import dispatch_rules, kitchen_rules, with_event_date


def kitchen_from_clean(clean: DataFrame, thresholds: C.Thresholds = C.Thresholds()) -> DataFrame:
    """Curated kitchen rows from clean-kitchen messages."""
    return with_event_date(kitchen_rules(parse_envelope(clean, schemas.KITCHEN_ENVELOPE), thresholds))


def dispatch_from_clean(clean: DataFrame, thresholds: C.Thresholds = C.Thresholds()) -> DataFrame:
    """Curated dispatch rows from clean-dispatch messages."""
    return with_event_date(dispatch_rules(parse_envelope(clean, schemas.DISPATCH_ENVELOPE), thresholds))


def dlq_from_messages(dead: DataFrame) -> DataFrame:
    """Classified dead letters from dead-letter messages."""
    return classify_dlq(decode_raw(dead))


@dataclass
class Curated:
    kitchen: DataFrame
    dispatch: DataFrame
    dlq: DataFrame


def curate(raw: DataFrame, thresholds: C.Thresholds = C.Thresholds(),
           topics: C.Topics = C.Topics()) -> Curated:
    routed = route(raw, topics)
    r = F.col("route")
    return Curated(
        kitchen=kitchen_from_clean(routed.filter(r == C.ROUTE_CLEAN_KITCHEN), thresholds),
        dispatch=dispatch_from_clean(routed.filter(r == C.ROUTE_CLEAN_DISPATCH), thresholds),
        dlq=dlq_from_messages(routed.filter(r == C.ROUTE_DLQ)),
    )


def load_curated(spark: SparkSession, kitchen_path: str, dispatch_path: str, dlq_path: str) -> Curated:
    """Stored curated tables (S3). A missing path fails the whole load.

    Schemas are declared, so no file listing is needed to infer them, and the
    ``event_date`` partition column is read from the directory layout. Dead
    letters are stored classified, so a day's report prunes to its directory.
    """
    def read(path: str, schema) -> DataFrame:
        return spark.read.schema(schema).parquet(path)

    return Curated(kitchen=read(kitchen_path, schemas.KITCHEN_CURATED),
                   dispatch=read(dispatch_path, schemas.DISPATCH_CURATED),
                   dlq=read(dlq_path, schemas.DLQ_CLASSIFIED))

"""The corpus pipeline: stages that each apply one training-data operator.

``STAGES`` names them in order. Every stage takes ``(spark, docs, sf_dir)`` and
returns a DataFrame; ``run`` writes each result as Parquet to the shared scratch
space and rereads it, so a lost executor never replays an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from batchtrace.llm.common import stored, table
from batchtrace.llm.queries import STAGES

#: SQL cannot state the trained and the fingerprint stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

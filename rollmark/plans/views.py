"""The stored tables under SQL names."""

from __future__ import annotations

from pyspark.sql import SparkSession

from rollmark.sinks.history import read_history
from rollmark.sinks.latest import read_mart

HISTORY_VIEW = "attendance_enriched"
MART_VIEW = "latest_attendance_mv"


def register_views(spark: SparkSession, *, history: str | None = None, state: str | None = None) -> None:
    """Make the history and the mart available to ``spark.sql``."""
    if history is not None:
        read_history(spark, history).createOrReplaceTempView(HISTORY_VIEW)
    if state is not None:
        read_mart(spark, state).createOrReplaceTempView(MART_VIEW)

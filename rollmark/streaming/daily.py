"""Marks per day, kept up to date over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollmark.sinks.deltas import NUMBER, DeltaTable
from rollmark.streaming.enrichment import usable_time
from rollmark.streaming.run import query_id, start_batches

_COLUMNS = "month string, day date, attendance_mark int, marks bigint"
_KEY = ("month", "day", "attendance_mark")


def _newest(rows: DataFrame) -> DataFrame:
    """A window's count as the last batch gave it; counts are totals, so older ones are replaced."""
    kept = rows.groupBy(*_KEY).agg(F.max(F.struct(NUMBER, "marks")).alias("row"))
    return kept.select(*_KEY, "row.marks", f"row.{NUMBER}").select(*rows.columns)


def table(path: str) -> DeltaTable:
    return DeltaTable(path, _COLUMNS, "month", _KEY, _newest, ("day",), whole=True)


def start_daily_marks(
    events: DataFrame, path: str, checkpoint: str, *, watermark: str = "2 days", every: str | None = None
) -> StreamingQuery:
    """Count events by the day of DATE_CREATE and by mark. A day's counts are in state until the
    watermark has passed it; each batch writes the days that it changed. Events without a usable time are
    left out, and those later than the watermark are dropped."""
    timed = events.filter(usable_time()).withColumn("_time", F.col("DATE_CREATE").try_cast("timestamp"))
    counted = timed.withWatermark("_time", watermark).groupBy(
        F.window("_time", "1 day"), F.col("ATTENDANCE_MARK").alias("attendance_mark")
    ).agg(F.count(F.lit(1)).alias("marks"))
    day = F.col("window.start").cast("date")
    rows = counted.select(F.date_format(day, "yyyyMM").alias("month"), day.alias("day"), "attendance_mark", "marks")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        table(path).add(batch, query_id(batch.sparkSession, checkpoint), batch_id)

    return start_batches(rows, on_batch, checkpoint, every=every, mode="update")


def read_daily_marks(spark: SparkSession, path: str) -> DataFrame:
    return table(path).read(spark).select("day", "attendance_mark", "marks")

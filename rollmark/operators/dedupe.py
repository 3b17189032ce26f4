"""Duplicate events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def duplicate_report(events: DataFrame, key: str = "ID") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def dedupe_events(events: DataFrame, key: str = "ID", first_by: str = "DATE_CREATE") -> DataFrame:
    """One row per key: the earliest, and among equally early ones the smallest row.

    Written as an aggregate because that drops copies before the shuffle: however many copies a
    key has, a map task sends one.
    """
    rest = [c for c in events.columns if c not in (key, first_by)]
    kept = events.groupBy(key).agg(F.min(F.struct(first_by, *rest)).alias("row"))
    return kept.select(*[key if c == key else f"row.{c}" for c in events.columns])

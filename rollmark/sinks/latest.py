"""The latest-state table behind the mart, kept up to date batch by batch."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollmark.operators.latest import latest_rows, to_mart
from rollmark.schemas import MARK_KEY, MART_VALUES, STORE, STORE_COLUMNS, STORE_TYPES
from rollmark.sinks.deltas import DeltaTable

# The lesson day is part of the key, so a key never changes its partition.
DAY = "LESSON_DATE"


def table(path: str) -> DeltaTable:
    return DeltaTable(path, STORE, DAY, tuple(MARK_KEY), latest_rows)


def read_state(spark: SparkSession, path: str, days: Collection[date] | None = None) -> DataFrame:
    """The latest row of each key, of some lesson days only if they are given."""
    wanted = None if days is None else {str(d) for d in days}.__contains__
    return table(path).read(spark, wanted).select(*STORE_COLUMNS)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """The mart: 30 columns, one row per key."""
    return to_mart(read_state(spark, path))


def upsert_latest(rows: DataFrame, path: str, run: str = "", batch: int | None = None) -> None:
    """Add rows in store types to the state. Adding the same rows again changes nothing.

    Nothing of the table is read or rewritten: a batch costs what its rows cost.
    """
    table(path).add(latest_rows(rows.select(*STORE_COLUMNS)), run, batch)


def compact_latest(spark: SparkSession, path: str, least: int = 1) -> list[str]:
    """Merge the days that at least ``least`` batches touched since they were merged."""
    return table(path).merge(spark, least)


# --- each column's latest value -----------------------------------------------------------------

# Per key and column: when its latest non-NULL value was set, by which event, and the value.
PARTIAL = ", ".join(
    [f"{k} {STORE_TYPES[k]}" for k in MARK_KEY]
    + [f"{c} struct<at: timestamp_ntz, id: string, value: {STORE_TYPES[c]}>" for c in MART_VALUES]
)


def _latest_parts(rows: DataFrame) -> DataFrame:
    """Partial states merged: per column the greatest (time, event), NULL where none has a value. The
    same whatever the order and grouping, so batches may be merged at any time."""
    parts = [c for c in rows.columns if c not in MARK_KEY]
    return rows.groupBy(*MARK_KEY).agg(*[F.max(c).alias(c) for c in parts]).select(*rows.columns)


def partial_table(path: str) -> DeltaTable:
    return DeltaTable(path, PARTIAL, DAY, tuple(MARK_KEY), _latest_parts)


def upsert_non_null(rows: DataFrame, path: str, run: str = "", batch: int | None = None) -> None:
    """Add rows in store types to the table of each column's latest value."""
    parts = [
        F.when(F.col(c).isNotNull(), F.struct(
            F.col("DATE_CREATE").alias("at"), F.col("ID").alias("id"), F.col(c).alias("value"))).alias(c)
        for c in MART_VALUES
    ]
    partial_table(path).add(_latest_parts(rows.select(*MARK_KEY, *parts)), run, batch)


def read_non_null(spark: SparkSession, path: str) -> DataFrame:
    """The mart whose columns each hold their latest non-NULL value: 30 columns, one row per key."""
    rows = partial_table(path).read(spark)
    return rows.select(*MARK_KEY, *[F.col(f"{c}.value").alias(c.lower()) for c in MART_VALUES])


def compact_non_null(spark: SparkSession, path: str, least: int = 1) -> list[str]:
    return partial_table(path).merge(spark, least)

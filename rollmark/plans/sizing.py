"""Measured sizes of lookup tables, so that only small ones are broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame) -> str:
    """SQL for the size of a row: its values as text, plus a fixed part per column."""
    texts = [f"coalesce(octet_length(CAST(`{c}` AS STRING)), 0)" for c in df.columns]
    return " + ".join([*texts, str(16 * len(df.columns))])


def fits_broadcast(
    *dims: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> list[bool]:
    """For each lookup table: is its measured size within the bound for a broadcast?

    All tables are measured in one job that returns one row per table.
    """
    sizes = [
        d.agg(
            F.lit(i).alias("dim"),
            F.count(F.lit(1)).alias("rows"),
            F.expr(f"coalesce(sum(CAST({_row_bytes(d)} AS BIGINT)), 0)").alias("bytes"),
        )
        for i, d in enumerate(dims)
    ]
    measured = {r["dim"]: r for r in reduce(DataFrame.unionByName, sizes).collect()}
    return [
        measured[i]["rows"] <= max_rows and measured[i]["bytes"] <= max_bytes
        for i in range(len(dims))
    ]

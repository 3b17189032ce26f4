"""Enriched events as text and plain integers to the store's types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollmark.functions.scalars import UUID_PATTERN, in_range
from rollmark.schemas import OUTPUT_COLUMNS, REQUIRED, STORE_RANGES

STORE_ZONE = "Europe/Moscow"


def _store_time(text: Column, zone: str) -> Column:
    """Wall-clock text of ``zone`` as UTC wall clock, cut to milliseconds."""
    wall = text.try_cast("timestamp_ntz")
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    return F.substring(utc.cast("string"), 1, 23).cast("timestamp_ntz")


def conform_enriched(
    enriched: DataFrame, *, zone: str = STORE_ZONE, uuid_ids: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): rows in store types, and rows whose required columns do not fit, with
    ``reason`` naming the first such column.

    DATE_CREATE becomes the UTC wall clock of the instant. A nullable column that does not fit
    its range becomes NULL. ``uuid_ids`` may be switched off for data with other ids.
    """
    special = {
        "ID": F.when(F.col("ID").rlike(UUID_PATTERN), F.lower("ID")) if uuid_ids else F.col("ID"),
        "LESSON_DATE": F.col("LESSON_DATE").try_cast("date"),
        "DATE_CREATE": _store_time(F.col("DATE_CREATE"), zone),
        **{c: in_range(F.col(c), *bounds) for c, bounds in STORE_RANGES.items()},
    }
    # Through inline() every value is converted once; a plain projection would be repeated in the
    # filters below.
    row = F.struct(*[special.get(c, F.col(c)).alias(c) for c in OUTPUT_COLUMNS])
    typed = enriched.select(F.inline(F.array(row)))
    reason = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])
    checked = typed.withColumn("reason", reason)
    return (
        checked.filter(F.col("reason").isNull()).drop("reason"),
        checked.filter(F.col("reason").isNotNull()),
    )

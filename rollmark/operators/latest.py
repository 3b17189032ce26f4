"""The latest mark per (journal, student, lesson, day)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rollmark.schemas import MARK_KEY, MART_VALUES


def latest_rows(events: DataFrame, key: list[str] = MARK_KEY) -> DataFrame:
    """The whole latest row per key; on equal times the greater ID, then the greater row.

    The aggregate keeps one row per key and map task before the shuffle, so a key with very
    many marks costs no more than others.
    """
    rest = [c for c in events.columns if c not in (*key, "DATE_CREATE", "ID")]
    latest = events.groupBy(*key).agg(F.max(F.struct("DATE_CREATE", "ID", *rest)).alias("row"))
    return latest.select(*[c if c in key else f"row.{c}" for c in events.columns])


def latest_rows_window(events: DataFrame, key: list[str] = MARK_KEY) -> DataFrame:
    """Same rows as ``latest_rows`` by ranking. Spark filters by rank before the shuffle, too."""
    rest = [c for c in events.columns if c not in (*key, "DATE_CREATE", "ID")]
    newest = [F.col(c).desc_nulls_last() for c in ("DATE_CREATE", "ID", *rest)]
    ranked = events.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*newest)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def to_mart(latest: DataFrame) -> DataFrame:
    """Enriched columns to the mart's 30 columns."""
    return latest.select(*MARK_KEY, *[F.col(c).alias(c.lower()) for c in MART_VALUES])


def latest_marks(enriched: DataFrame) -> DataFrame:
    """The latest-state mart of enriched events: one row per key, 30 columns."""
    return to_mart(latest_rows(enriched))


def latest_marks_window(enriched: DataFrame) -> DataFrame:
    return to_mart(latest_rows_window(enriched))


def latest_non_null(enriched: DataFrame) -> DataFrame:
    """Like ``latest_marks``, but each column on its own takes its latest non-NULL value."""
    order = F.struct("DATE_CREATE", "ID")
    return enriched.groupBy(*MARK_KEY).agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c.lower())
            for c in MART_VALUES
        ]
    )


def merge_latest(state: DataFrame, changes: DataFrame) -> DataFrame:
    """Latest rows kept so far, merged with further events in any order. Both sides keep their
    ID, so the result is what ``latest_rows`` gives over all events at once."""
    return latest_rows(state.unionByName(changes.select(*state.columns)))

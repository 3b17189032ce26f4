"""The append-only history, partitioned by lesson month."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollmark.functions.scalars import lesson_month
from rollmark.schemas import STORE, STORE_COLUMNS
from rollmark.sinks.deltas import DeltaTable, Step

MONTH = "lesson_month"
# Sort order inside files: lesson day, student, lesson.
SORT = ["LESSON_DATE", "STUDENT_ID", "LESSON_ID"]
HISTORY = f"{STORE}, {MONTH} string"
# Columns that rows are looked up by. Files keep a Bloom filter of each, since the sort order leaves
# their values spread over row groups.
LOOKED_UP = ["ID", "STUDENT_ID", "JOURNAL_ID", "LESSON_ID"]


def _first_by_id(rows: DataFrame) -> DataFrame:
    """One row per month and ID: the earliest, and among equally early ones the smallest row. As an
    aggregate, which drops copies before the shuffle."""
    rest = [c for c in rows.columns if c not in (MONTH, "ID", "DATE_CREATE")]
    kept = rows.groupBy(MONTH, "ID").agg(F.min(F.struct("DATE_CREATE", *rest)).alias("row"))
    return kept.select(*[c if c in (MONTH, "ID") else f"row.{c}" for c in rows.columns])


def table(path: str, **options: str) -> DeltaTable:
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in LOOKED_UP}
    return DeltaTable(path, HISTORY, MONTH, (MONTH, "ID"), _first_by_id, (*SORT, "DATE_CREATE", "ID"), options={**blooms, **options})


def append_history(rows: DataFrame, path: str, run: str = "", batch: int | None = None) -> None:
    """Append rows in store types (see ``conform_enriched``) as a batch. The history is not read:
    an ID that it has already is left out when it is read, and goes when its month is merged. A batch of
    a run that is done again adds nothing."""
    dated = rows.select(*STORE_COLUMNS, lesson_month(F.col("LESSON_DATE")).alias(MONTH))
    table(path).add(dated, run, batch)


def read_history(
    spark: SparkSession, path: str, start: date | None = None, end: date | None = None, *, where: Step | None = None
) -> DataFrame:
    """History rows, each ID once in its month, with lesson days from ``start`` to ``end``. Only their
    months are opened. ``where`` filters rows before copies are looked for, so it reaches the files; it must
    keep or drop all copies of an ID."""
    low, high = (None if d is None else d.strftime("%Y%m") for d in (start, end))

    def wanted(month: str) -> bool:
        return (low is None or month >= low) and (high is None or month <= high)

    def filtered(rows: DataFrame) -> DataFrame:
        if start is not None:
            rows = rows.filter((F.col(MONTH) >= low) & (F.col("LESSON_DATE") >= F.lit(start)))
        if end is not None:
            rows = rows.filter((F.col(MONTH) <= high) & (F.col("LESSON_DATE") <= F.lit(end)))
        return where(rows) if where else rows

    return table(path).read(spark, wanted, where=filtered)


def find_mark(
    spark: SparkSession, path: str, *, journal_id: int, student_id: int, lesson_id: int, day: date
) -> DataFrame:
    """The latest mark of one key with TYPE_MARK 0, as at most one row. The key's columns are filtered in
    the files of one month, where sort order and Bloom filters skip what cannot hold it."""
    key = (
        (F.col("JOURNAL_ID") == journal_id) & (F.col("STUDENT_ID") == student_id)
        & (F.col("LESSON_ID") == lesson_id) & (F.col("TYPE_MARK") == 0)
    )
    rows = read_history(spark, path, day, day, where=lambda df: df.filter(key))
    newest = rows.orderBy(F.col("DATE_CREATE").desc(), F.col("ID").desc()).limit(1)
    return newest.select("ID", "MARKED_BY", "ATTENDANCE_MARK", "MARKED_BY_ROLE", "DATE_CREATE")


def compact_history(spark: SparkSession, path: str, least: int = 1) -> list[str]:
    """Merge the months that at least ``least`` batches touched since they were merged: sorted files
    that do not overlap, without copies of an ID. Other months stay as they are."""
    return table(path).merge(spark, least)


def file_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Per file of a merged month: number of rows, first and last (LESSON_DATE, STUDENT_ID, LESSON_ID)."""
    view = table(path).view(spark)
    merged = table(path).files(spark, [(folder, month) for month, folder in sorted(view.parts.items())])
    key = F.struct(*SORT)
    return merged.groupBy(MONTH, "file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("first"), F.max(key).alias("last"))

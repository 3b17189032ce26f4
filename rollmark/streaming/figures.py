"""Attendance figures kept up to date batch by batch.

A batch of marks changes the latest state: some rows go out, others come in. The figures are counts, so
it is enough to add the rows that came in and take off those that went out, in each report's cells. Cells
are summed when they are read; a batch costs what it changes, whatever the size of the mart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollmark.operators import reports
from rollmark.operators.latest import latest_rows, merge_latest
from rollmark.schemas import MARK_KEY, STORE_COLUMNS, STORE_TYPES
from rollmark.sinks import latest as latest_sink
from rollmark.sinks.deltas import NUMBER, DeltaTable
from rollmark.streaming.run import query_id, start_batches
from rollmark.streaming.store import MERGE_EVERY, store_rows

# What each report tells apart; the mart's names.
CELLS = {
    "marks_by_group": ["group_short_title", "attendance_mark"],
    "student_attendance": ["STUDENT_ID", "student_fio", "group_short_title", "attendance_mark"],
    "marks_on_date": ["LESSON_DATE", "group_short_title"],
    "marks_by_teacher": ["marked_by", "teacher_fio", "attendance_mark"],
    "teacher_attendance_pct": ["marked_by", "teacher_fio", "kafedra", "attendance_mark"],
}
_BY_NAME = {c.lower(): (c, kind) for c, kind in STORE_TYPES.items()}
DIMS = sorted({c for cells in CELLS.values() for c in cells})
_COLUMNS = "report string, " + ", ".join(f"{c} {_BY_NAME[c.lower()][1]}" for c in DIMS) + ", n bigint"


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of the state that went out (``n`` = -1) and came in (1); what stays the same is in both."""
    out, new = (df.select(*STORE_COLUMNS).withColumn("n", F.lit(n).cast("bigint")) for df, n in ((before, -1), (after, 1)))
    return out.unionByName(new)


def cells(changes: DataFrame) -> DataFrame:
    """Changes to the cells of all reports; cells that do not change are left out."""
    each = F.explode(F.array(*[
        F.struct(F.lit(report).alias("report"), *[
            (F.col(_BY_NAME[c.lower()][0]) if c in dims else F.lit(None).cast(_BY_NAME[c.lower()][1])).alias(c)
            for c in DIMS
        ])
        for report, dims in CELLS.items()
    ]))
    counted = changes.select(each.alias("cell"), "n").groupBy("cell").agg(F.sum("n").alias("n"))
    return counted.filter("n <> 0").select("cell.*", "n")


def _summed(rows: DataFrame) -> DataFrame:
    summed = rows.groupBy("report", *DIMS).agg(F.sum("n").alias("n"), F.max(NUMBER).alias(NUMBER))
    return summed.filter("n <> 0").select(*rows.columns)


def table(path: str) -> DeltaTable:
    return DeltaTable(path, _COLUMNS, "report", ("report", *DIMS), _summed, whole=True)


def update_figures(
    rows: DataFrame, state: str, figures: str, run: str, batch: int
) -> None:
    """Take the marks of one batch (store types) into the latest state and into the figures. A batch
    that is done again changes nothing: it meets the state that the other batches left."""
    spark = rows.sparkSession
    new = latest_rows(rows.select(*STORE_COLUMNS)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # At most as many as there are lesson days.
        days = {str(r[0]) for r in new.select(latest_sink.DAY).distinct().collect()}
        kept = latest_sink.table(state).read(spark, days.__contains__, but=(run, batch)).select(*STORE_COLUMNS)
        before = kept.join(new.select(*MARK_KEY), MARK_KEY, "left_semi")
        after = merge_latest(before, new)
        table(figures).add(cells(changed_rows(before, after)), run, batch)
        latest_sink.upsert_latest(new, state, run, batch)
    finally:
        new.unpersist()


def start_figures(
    messages: DataFrame, state: str, figures: str, checkpoint: str, *, every: str | None = None,
    on_batch_done: Callable[[int], None] | None = None, merge_every: int = MERGE_EVERY, **conform,
) -> StreamingQuery:
    """Keep the latest state and the figures up to date from enriched messages."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows, _ = store_rows(batch, **conform)
        update_figures(rows, state, figures, query_id(spark, checkpoint), batch_id)
        if batch_id % merge_every == merge_every - 1:
            table(figures).merge(spark)
            latest_sink.compact_latest(spark, state, 2)
        if on_batch_done is not None:
            on_batch_done(batch_id)

    return start_batches(messages, on_batch, checkpoint, every=every)


def read_cells(spark: SparkSession, path: str, report: str) -> DataFrame:
    return table(path).read(spark, lambda value: value == report).select(*CELLS[report], "n")


def read_report(
    spark: SparkSession, path: str, report: str, *, groups: Sequence[str] | None = None, as_of: date | None = None
) -> DataFrame:
    """A report as ``rollmark.operators.reports`` gives it over the mart."""
    found = read_cells(spark, path, report)
    if report == "marks_on_date":
        return reports.marks_on_date(found, as_of, groups, weight="n")
    if report in ("marks_by_group", "student_attendance"):
        return getattr(reports, report)(found, groups, weight="n")
    return getattr(reports, report)(found, weight="n")

"""Attendance reports over the latest-state mart.

Mark 1 is present, mark 0 absent. Shares are of present plus absent, so they add up to 100;
other marks count in totals only. ``weight`` names a column of counts where a row stands for several
marks; without it a row is one mark.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F


def _marks(weight: str | None, when: Column | None = None) -> Column:
    one = F.lit(1) if weight is None else F.col(weight)
    counted = F.coalesce(F.sum(one if when is None else F.when(when, one)), F.lit(0))
    return counted.cast("bigint")


def _present(weight: str | None = None) -> Column:
    return _marks(weight, F.col("attendance_mark") == 1)


def _absent(weight: str | None = None) -> Column:
    return _marks(weight, F.col("attendance_mark") == 0)


def in_groups(mart: DataFrame, groups: Sequence[str] | None) -> DataFrame:
    """The dashboard's group filter; None selects all rows."""
    return mart if groups is None else mart.filter(F.col("group_short_title").isin(list(groups)))


def marks_by_group(mart: DataFrame, groups: Sequence[str] | None = None, *, weight: str | None = None) -> DataFrame:
    """Number of marks per group and mark value."""
    return in_groups(mart, groups).groupBy("group_short_title", "attendance_mark").agg(
        _marks(weight).alias("marks")
    )


def student_attendance(mart: DataFrame, groups: Sequence[str] | None = None, *, weight: str | None = None) -> DataFrame:
    """Present and absent counts per student."""
    return in_groups(mart, groups).groupBy("STUDENT_ID", "student_fio", "group_short_title").agg(
        _present(weight).alias("present"), _absent(weight).alias("absent")
    )


def marks_on_date(
    mart: DataFrame, as_of: date, groups: Sequence[str] | None = None, *, weight: str | None = None
) -> DataFrame:
    """Number of marks for lessons on one day, as one row."""
    return in_groups(mart, groups).filter(F.col("LESSON_DATE") == F.lit(as_of)).agg(
        _marks(weight).alias("marks")
    )


def marks_by_teacher(mart: DataFrame, *, weight: str | None = None) -> DataFrame:
    """Number of marks per teacher and mark value, for marks made by teachers. Teachers are told
    apart by id; two of one name stay two."""
    return mart.filter(F.col("teacher_fio").isNotNull()).groupBy("marked_by", "teacher_fio", "attendance_mark").agg(
        _marks(weight).alias("marks")
    )


def _shares(weight: str | None) -> list[Column]:
    known = _present(weight) + _absent(weight)
    return [
        _marks(weight).alias("marks"),
        (100.0 * F.try_divide(_present(weight), known)).alias("present_pct"),
        (100.0 * F.try_divide(_absent(weight), known)).alias("absent_pct"),
    ]


def teacher_attendance_pct(mart: DataFrame, *, weight: str | None = None) -> DataFrame:
    """Per teacher and department: share of present and absent marks in percent; NULL where a
    teacher has neither."""
    return mart.filter(F.col("teacher_fio").isNotNull()).groupBy("marked_by", "teacher_fio", "kafedra").agg(
        *_shares(weight)
    )


def faculty_rollup(mart: DataFrame, *, weight: str | None = None) -> DataFrame:
    """The same shares per department, per faculty and for the whole school, as one table: ``level`` is
    0 for a department, 1 for a faculty (kafedra NULL), 3 for the school (both NULL)."""
    marked = mart.filter(F.col("teacher_fio").isNotNull())
    return marked.rollup("faculty", "kafedra").agg(
        F.grouping_id().cast("int").alias("level"), *_shares(weight)
    ).select("faculty", "kafedra", "level", "marks", "present_pct", "absent_pct")

"""Events joined with student and teacher attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollmark.plans.sizing import fits_broadcast
from rollmark.plans.skew import ROWS_PER_TASK, lookup_join
from rollmark.schemas import OUTPUT_COLUMNS

STUDENT_KEY = "ENRICHED_STUDENT_ID"
TEACHER_KEY = "ENRICHED_MARKED_BY"


def teacher_marked() -> Column:
    """Marked by a teacher or the dean's office. NULL roles count as not."""
    return ~F.col("MARKED_BY_ROLE").isin(0, 1)


def lookup_ids(events: DataFrame) -> DataFrame:
    """Distinct ids the events refer to: (kind, id) with kind student or teacher."""
    pair = F.array(
        F.struct(F.lit("student").alias("kind"), F.col("STUDENT_ID").cast("string").alias("id")),
        F.struct(
            F.lit("teacher").alias("kind"),
            F.when(teacher_marked(), F.col("MARKED_BY").cast("string")).alias("id"),
        ),
    )
    return events.select(F.inline(pair)).filter(F.col("id").isNotNull()).distinct()


def missing_lookup_ids(events: DataFrame, students: DataFrame, teachers: DataFrame) -> DataFrame:
    """Ids the events refer to that the directory does not know: (kind, id)."""
    known = students.select(F.lit("student").alias("kind"), F.col(STUDENT_KEY).alias("id")).unionByName(
        teachers.select(F.lit("teacher").alias("kind"), F.col(TEACHER_KEY).alias("id"))
    )
    return lookup_ids(events).join(known, ["kind", "id"], "left_anti")


def with_people(
    events: DataFrame,
    students: DataFrame,
    teachers: DataFrame,
    *,
    broadcast: tuple[bool, bool] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """Events with all attributes plus ``student_found`` and ``teacher_found``.

    A row marked by a student never gets teacher attributes, even where the marker's id equals
    a teacher's id. ``broadcast`` says which of the two views may be broadcast; unless given,
    both are measured. Events should be unique by ID: that is what spreads a hot key.
    """
    by_student, by_teacher = broadcast or fits_broadcast(students, teachers)
    keyed = _keyed(events)
    counted = None if count_from is None else _keyed(count_from)
    joined = lookup_join(
        keyed, students.withColumn("student_found", F.lit(True)), [STUDENT_KEY],
        broadcast=by_student, row_id=["ID"], rows_per_task=rows_per_task,
        count_from=keyed if counted is None else counted,
    )
    joined = lookup_join(
        joined, teachers.withColumn("teacher_found", F.lit(True)), [TEACHER_KEY],
        broadcast=by_teacher, row_id=["ID"], rows_per_task=rows_per_task,
        count_from=keyed if counted is None else counted,
    )
    return joined.withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("student_found", "teacher_found")}
    )


def _keyed(events: DataFrame) -> DataFrame:
    return events.withColumns(
        {
            STUDENT_KEY: F.col("STUDENT_ID").cast("string"),
            TEACHER_KEY: F.when(teacher_marked(), F.col("MARKED_BY").cast("string")),
        }
    )


def enrich_events(events: DataFrame, students: DataFrame, teachers: DataFrame, **options) -> DataFrame:
    """The 31-column enriched event, one row per event. Attributes of people the directory does
    not know are NULL; attributes it lacks for people it knows are '' or 0."""
    return with_people(events, students, teachers, **options).select(*OUTPUT_COLUMNS)


def enrichment_hits(events: DataFrame, students: DataFrame, teachers: DataFrame, **options) -> DataFrame:
    """How many events found their student and their teacher, as one row."""
    rows = with_people(events, students, teachers, **options)
    asks_teacher = F.col(TEACHER_KEY).isNotNull()
    return rows.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("student_found").alias("student_found"),
        F.count_if(F.col(STUDENT_KEY).isNotNull() & ~F.col("student_found")).alias("student_missing"),
        F.count_if("teacher_found").alias("teacher_found"),
        F.count_if(asks_teacher & ~F.col("teacher_found")).alias("teacher_missing"),
    )

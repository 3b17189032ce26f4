"""Admission of mark requests: input checks, access rules, lesson checks and the role of the
requester. All requests are judged at once; each gets the first reason that applies, or none.

A request has the text fields journalId, userId, lessonId, attendance and lessonDate (optional),
plus requester_id, requester_dean_id, requester_kind ('employee' or 'student'), requested_at
and request_id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rollmark.functions.lessons import DEAN, DEAN_MARKS, MARKS, MONITOR, STUDENT, TEACHER, slot_table
from rollmark.functions.scalars import micros_text, number_of, stable_id, time_of_day, whole_number
from rollmark.plans.sizing import fits_broadcast
from rollmark.plans.skew import ROWS_PER_TASK, lookup_join
from rollmark.schemas import STORE_RANGES

REQUEST_FIELDS = ["journalId", "userId", "lessonId", "attendance", "lessonDate"]


@dataclass(frozen=True)
class School:
    """The tables requests are judged by.

    lessons (ID, DATE, NUMBER, BLOCKED); responsible_teachers and responsible_students
    (JOURNAL_ID, RESPONSIBLE_ID); grants (user_id, journal_id, grant_kind in granted, group);
    dean_office (user_id). Ids are bigint.
    """

    lessons: DataFrame
    responsible_teachers: DataFrame
    responsible_students: DataFrame
    grants: DataFrame
    dean_office: DataFrame


def parse_requests(requests: DataFrame) -> DataFrame:
    """Add the typed ids and the mark, NULL where the text is not a number."""
    return requests.withColumns(
        {
            "journal_id": whole_number(F.col("journalId")),
            "user_id": whole_number(F.col("userId")),
            "lesson_id": whole_number(F.col("lessonId")),
            "mark": whole_number(F.col("attendance")),
        }
    )


def input_reason() -> Column:
    """First fault of the request itself."""
    ids = {
        "journalId": ("journal_id", "bad_journal", STORE_RANGES["JOURNAL_ID"][2]),
        "userId": ("user_id", "bad_user", STORE_RANGES["STUDENT_ID"][2]),
        "lessonId": ("lesson_id", "bad_lesson", STORE_RANGES["LESSON_ID"][2]),
    }
    empty = F.lit(True)
    for f in REQUEST_FIELDS:
        empty = empty & F.col(f).isNull()
    checks = [
        F.when(empty, "empty"),
        *[F.when(F.col(f).isNull(), f"missing:{f}") for f in REQUEST_FIELDS[:4]],
        *[
            F.when(~F.coalesce((number_of(F.col(f)) > 0) & (F.col(typed) <= high), F.lit(False)), reason)
            for f, (typed, reason, high) in ids.items()
        ],
        F.when(~F.coalesce(F.col("mark").isin(MARKS), F.lit(False)), "bad_attendance"),
    ]
    return F.coalesce(*checks)


def _lookups(school: School) -> list[tuple[DataFrame, list[str]]]:
    """What the rules look up, each as (table with one row per key, key)."""
    flag = F.lit(True)
    grants = school.grants.groupBy(
        F.col("user_id").alias("requester_id"), F.col("journal_id")
    ).agg(
        F.bool_or(F.col("grant_kind") == "granted").alias("has_grant"),
        F.bool_or(F.col("grant_kind") == "group").alias("has_group"),
    )
    teachers = school.responsible_teachers.select(
        F.col("JOURNAL_ID").alias("journal_id"), F.col("RESPONSIBLE_ID").alias("requester_dean_id")
    ).distinct().withColumn("is_responsible", flag)
    monitors = school.responsible_students.select(
        F.col("JOURNAL_ID").alias("journal_id"), F.col("RESPONSIBLE_ID").alias("requester_id")
    ).distinct().withColumn("is_monitor", flag)
    deans = school.dean_office.select(F.col("user_id").alias("requester_id")).distinct().withColumn(
        "is_dean", flag
    )
    lessons = school.lessons.groupBy(F.col("ID").alias("lesson_id")).agg(
        F.max(F.struct(F.col("DATE").alias("lesson_date"), F.col("NUMBER"), F.col("BLOCKED"))).alias("lesson")
    )
    return [
        (grants, ["requester_id", "journal_id"]),
        (teachers, ["journal_id", "requester_dean_id"]),
        (monitors, ["journal_id", "requester_id"]),
        (deans, ["requester_id"]),
        (lessons, ["lesson_id"]),
    ]


def lookup_sizes(school: School) -> list[bool]:
    """Which of the lookups are small enough to broadcast, as ``broadcast`` of the functions below."""
    return fits_broadcast(*[table for table, _ in _lookups(school)])


def with_facts(
    requests: DataFrame,
    school: School,
    *,
    rows_per_task: int = ROWS_PER_TASK,
    broadcast: list[bool] | None = None,
) -> DataFrame:
    """Parsed requests with what the access and lesson rules need to know about them."""
    dims = _lookups(school)
    parsed = parse_requests(requests)
    small = broadcast or lookup_sizes(school)
    out = parsed
    for (dim, keys), fits in zip(dims, small):
        out = lookup_join(
            out, dim, keys, broadcast=fits, row_id=["request_id"],
            rows_per_task=rows_per_task, count_from=parsed,
        )
    flags = ["has_grant", "has_group", "is_responsible", "is_monitor", "is_dean"]
    return out.withColumns({f: F.coalesce(f, F.lit(False)) for f in flags})


def access_reason() -> Column:
    """Why the requester may not mark this student in this journal."""
    kind = F.col("requester_kind")
    dean_id = F.coalesce(F.col("requester_dean_id"), F.lit(0))
    employee = F.when(dean_id == 0, "no_dean_id").when(
        ~(F.col("has_grant") | F.col("is_responsible")), "no_journal_access"
    )
    reaches = F.col("has_group") | F.col("has_grant")
    leads = F.col("is_monitor") | F.col("has_grant")
    student = (
        F.when(leads, F.when(~reaches, "no_journal_access"))
        .when(~F.col("requester_id").eqNullSafe(F.col("user_id")), "only_self")
        .when(~F.col("has_group"), "no_journal_access")
    )
    return F.when(kind == "employee", employee).when(kind == "student", student).otherwise("unknown_kind")


def supplied_day(text: Column) -> Column:
    """The day a whole text stands for: yyyy-MM-dd or dd.MM.yyyy, either with a time of day
    (HH:mm, HH:mm:ss, with fractions) after a space or T; NULL for anything else."""
    iso = F.regexp_replace(F.trim(text), r"\A(\d{2})\.(\d{2})\.(\d{4})", "$3-$2-$1")
    known = iso.rlike(r"\A\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?\z")
    return F.when(known, iso).try_cast("timestamp_ntz").cast("date")


def marker_reason() -> Column:
    """The id the mark would be made under does not fit an event."""
    _, low, high = STORE_RANGES["MARKED_BY"]
    return F.when(~derived_marker().between(low, high), "bad_marker")


def lesson_reason() -> Column:
    """Why the lesson cannot take the mark."""
    supplied = F.col("lessonDate")
    return (
        F.when(F.col("lesson").isNull(), "lesson_not_found")
        .when(F.col("lesson.BLOCKED"), "lesson_blocked")
        .when(
            supplied.isNotNull() & ~supplied_day(supplied).eqNullSafe(F.col("lesson.lesson_date")),
            "date_mismatch",
        )
    )


def with_slot(requests: DataFrame) -> DataFrame:
    """Add the slot of the lesson number and ``in_slot``: is the request strictly inside it?"""
    slots = F.broadcast(slot_table(requests.sparkSession))
    clock = time_of_day(F.col("requested_at"))
    return requests.join(slots, "NUMBER", "left").withColumn(
        "in_slot", (clock > F.col("slot_start")) & (clock < F.col("slot_end"))
    )


def slot_reason() -> Column:
    """Students mark during the lesson only."""
    return F.when(
        F.col("requester_kind") == "student",
        F.when(F.col("slot_start").isNull(), "bad_slot").when(~F.col("in_slot"), "outside_slot"),
    )


def derived_role() -> Column:
    """Role the mark is made in."""
    dean = F.col("is_dean") & F.col("mark").isin(DEAN_MARKS)
    return F.when(
        F.col("requester_kind") == "employee", F.when(dean, DEAN).otherwise(TEACHER)
    ).when(
        F.col("requester_kind") == "student",
        F.when(F.col("is_monitor") | F.col("has_grant"), MONITOR).otherwise(STUDENT),
    ).cast("int")


def derived_marker() -> Column:
    """Id the mark is made under: the dean's-office id for employees, the own id for students."""
    return F.when(F.col("requester_kind") == "employee", F.col("requester_dean_id")).otherwise(
        F.col("requester_id")
    )


def check_access(requests: DataFrame, school: School, **options) -> DataFrame:
    """Requests with ``access_reason`` and the role and marker they would have."""
    return with_facts(requests, school, **options).withColumns(
        {"access_reason": access_reason(), "marked_by_role": derived_role(), "marked_by": derived_marker()}
    )


def validate_marks(requests: DataFrame, school: School, **options) -> DataFrame:
    """Requests with ``reject_reason``: the first failure in the order input, access, lesson,
    time; NULL for requests that pass."""
    facts = with_facts(requests, school, **options).withColumn("NUMBER", F.col("lesson.NUMBER"))
    return with_slot(facts).withColumns(
        {
            "reject_reason": F.coalesce(
                input_reason(), marker_reason(), access_reason(), lesson_reason(), slot_reason()
            ),
            "marked_by_role": derived_role(),
            "marked_by": derived_marker(),
        }
    )


def to_events(validated: DataFrame) -> DataFrame:
    """The raw events of the requests that passed. IDs follow from the request, so judging the
    same requests again gives the same events."""
    day = F.col("lesson.lesson_date")
    return validated.filter(F.col("reject_reason").isNull()).select(
        stable_id(F.col("request_id"), F.col("requester_id"), F.col("requested_at")).alias("ID"),
        F.col("journal_id").try_cast("int").alias("JOURNAL_ID"),
        F.col("user_id").try_cast("int").alias("STUDENT_ID"),
        F.date_format(day, "yyyy-MM-dd").alias("LESSON_DATE"),
        F.col("mark").cast("int").alias("ATTENDANCE_MARK"),
        F.col("marked_by").cast("bigint").alias("MARKED_BY"),
        micros_text(F.col("requested_at")).alias("DATE_CREATE"),
        F.col("lesson_id").cast("bigint").alias("LESSON_ID"),
        F.lit(0).alias("TYPE_MARK"),
        F.lit(None).cast("int").alias("NUMBER_CERT"),
        F.col("marked_by_role").alias("MARKED_BY_ROLE"),
    )

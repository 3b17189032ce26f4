"""The user directory as two flat lookup tables: students and teachers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from rollmark.functions.scalars import age_on, digits_or_zero, instant_date, text_or_empty
from rollmark.schemas import STUDENT, TEACHER, names


def flatten_directory(documents: DataFrame, as_of: date | Column) -> DataFrame:
    """One row per document (PERSONAL, EDUCATION, WORK), missing attributes as '' or 0.

    Only students have their first EDUCATION entry read and only employees their first WORK
    entry. An employee's job title replaces the personal work position even where it is empty;
    without WORK the personal one stays.
    """
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    person = F.col("PERSONAL")
    is_student = F.coalesce(person["type"] == "student", F.lit(False))
    is_employee = F.coalesce(person["type"] == "employee", F.lit(False))
    study = F.when(is_student, F.get("EDUCATION", F.lit(0)))
    work = F.when(is_employee, F.get("WORK", F.lit(0)))

    return documents.select(
        person["BITRIX_USER_ID"].alias("user_key"),
        person["ID_DECANAT"].cast("string").alias("dean_key"),
        text_or_empty(person["fullname"]).alias("fio"),
        text_or_empty(person["lastname"]).alias("last_name"),
        text_or_empty(person["name"]).alias("first_name"),
        text_or_empty(person["surname"]).alias("middle_name"),
        age_on(instant_date(person["birthdate"]), day).alias("age"),
        text_or_empty(person["sex"]).alias("sex"),
        digits_or_zero(study["edu_year"]).alias("admission_year"),
        text_or_empty(study["edu_qualification"]).alias("qualification"),
        digits_or_zero(study["edu_course"]).alias("course"),
        text_or_empty(study["department"]["short_title"]).alias("group_short_title"),
        text_or_empty(study["specialization"]["title"]).alias("specialization_title"),
        F.when(is_employee & F.col("WORK").isNotNull(), text_or_empty(work["job_title"]))
        .otherwise(text_or_empty(person["WORK_POSITION"])).alias("work_position"),
        text_or_empty(work["department"]["FACULTY_NAME_DECANAT"]).alias("faculty"),
        text_or_empty(work["department"]["title"]).alias("kafedra"),
    )


def _one_per_key(flat: DataFrame, key: str, ddl: str, attributes: list[str]) -> DataFrame:
    """Keyed view with exactly one row per usable key. Of several documents with one key the
    greatest row is kept, so the choice does not depend on their order."""
    target = names(ddl)
    usable = F.col(key).isNotNull() & ~F.col(key).isin("", "0")
    kept = flat.filter(usable).groupBy(F.col(key).alias(target[0])).agg(
        F.max(F.struct(*[F.col(a).alias(t) for a, t in zip(attributes, target[1:])])).alias("row")
    )
    return kept.select(target[0], "row.*")


def student_view(flat: DataFrame) -> DataFrame:
    """Students by user id."""
    return _one_per_key(
        flat, "user_key", STUDENT,
        ["fio", "last_name", "first_name", "middle_name", "age", "sex", "admission_year",
         "qualification", "course", "group_short_title", "specialization_title"],
    )


def teacher_view(flat: DataFrame) -> DataFrame:
    """Teachers by dean's-office id."""
    return _one_per_key(
        flat, "dean_key", TEACHER,
        ["fio", "last_name", "first_name", "middle_name", "work_position", "faculty", "kafedra",
         "age", "sex"],
    )


def restrict_view(view: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of a keyed view whose key occurs in the one-column ``ids``."""
    wanted = ids.toDF(view.columns[0]).distinct()
    return view.join(wanted, view.columns[0], "left_semi")

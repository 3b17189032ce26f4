"""Competing marks for one (journal, student, lesson, day), settled by the role hierarchy.

Requests are taken in order of (DATE_CREATE, ID). Each is accepted or rejected given the mark
accepted last, so the answer depends on earlier answers. It can still be computed with running
values, because of three facts about the rules:

* Once an employee's mark stands, only employees can change it, and whatever is decided, the
  marker and value that stand afterwards are those of the latest employee request.
* Before that, the marker that stands is the one of the latest monitor request, or of the first
  request if there was none. The value is that of the latest request among these: the monitor
  requests, the first request, and plain requests of the standing marker.
* Hence the first accepted employee request is the first one that differs from what would stand
  if there were only student requests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollmark.functions.lessons import DEAN, MONITOR, STUDENT, TEACHER
from rollmark.operators.latest import latest_rows
from rollmark.plans.ordered import Ordered, over_ordered_groups
from rollmark.plans.skew import ROWS_PER_TASK
from rollmark.schemas import MARK_KEY

ORDER = ["_turn", "DATE_CREATE", "ID", "MARKED_BY", "MARKED_BY_ROLE", "ATTENDANCE_MARK"]


def _settle(rows: DataFrame, groups: Ordered) -> DataFrame:
    role, by, mark = F.col("MARKED_BY_ROLE"), F.col("MARKED_BY"), F.col("ATTENDANCE_MARK")
    yes = F.lit(True)
    rows = rows.withColumns(
        {
            "_employee": F.coalesce(role.isin(TEACHER, DEAN), F.lit(False)),
            "_monitor": F.coalesce(role == MONITOR, F.lit(False)),
            # An earlier mark without a known role stands like a plain student's.
            "_plain": F.coalesce(role == STUDENT, F.lit(False))
            | ((F.col("_turn") == 0) & ~F.coalesce(role.isin(MONITOR, TEACHER, DEAN), F.lit(False))),
        }
    )
    employee, monitor, plain = F.col("_employee"), F.col("_monitor"), F.col("_plain")
    known = employee | monitor | plain

    rows = groups.carry(
        rows,
        last_before={
            "_seen": F.when(known, yes),
            "_employee_mark": F.when(employee, F.struct(by.alias("by"), mark.alias("mark"))),
        },
        last_upto={"_monitor_by": F.when(monitor, F.struct(by.alias("by")))},
        first_upto={"_first_by": F.when(known, F.struct(by.alias("by")))},
    )
    first = known & F.col("_seen").isNull()
    holder = F.coalesce("_monitor_by", "_first_by")["by"]
    sets_mark = first | monitor | (plain & by.eqNullSafe(holder))
    rows = groups.settle(rows.withColumns({"_first": first, "_sets_mark": sets_mark}))

    rows = groups.settle(
        groups.carry(
            rows,
            last_before={
                "_stands": F.when(F.col("_sets_mark"), F.struct(by.alias("by"), mark.alias("mark")))
            },
        )
    )
    stands, first = F.col("_stands"), F.col("_first")
    own = by.eqNullSafe(stands["by"])
    same = own & mark.eqNullSafe(stands["mark"])
    opens = employee & (first | ~same)
    student_ok = (first & ~employee) | (monitor & ~same) | (plain & own & ~same)
    rows = groups.carry(
        rows,
        last_before={
            "_employee_stands": F.when(opens, yes),
            "_role_stands": F.when(student_ok, F.struct(role.alias("role"))),
        },
    )

    repeated = by.eqNullSafe(F.col("_employee_mark.by")) & mark.eqNullSafe(F.col("_employee_mark.mark"))
    under_employee = F.when(employee, F.when(repeated, "same_value")).otherwise("teacher_mark")
    under_student = (
        F.when(employee, F.when(~opens, "same_value"))
        .when(monitor, F.when(same, "same_value"))
        .when(~own & F.coalesce(F.col("_role_stands.role") == MONITOR, F.lit(False)), "monitor_mark")
        .when(~own, "other_user")
        .when(same, "same_value")
    )
    reason = (
        F.when(~known, "unknown_role")
        .when(first, F.lit(None))
        .when(F.col("_employee_stands").isNotNull(), under_employee)
        .otherwise(under_student)
    )
    return rows.withColumn("reject_reason", reason)


def arbitrate_marks(
    requests: DataFrame,
    history: DataFrame | None = None,
    *,
    rows_per_task: int = ROWS_PER_TASK,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """Requests (raw event columns) with ``accepted`` and ``reject_reason``.

    ``history`` are marks accepted before; the latest one with TYPE_MARK 0 per key is what the
    first request of that key meets.
    """
    rows = requests.withColumn("_turn", F.lit(1))
    if history is not None:
        keys = requests.select(*MARK_KEY).distinct()
        earlier = latest_rows(
            history.filter(F.col("TYPE_MARK") == 0)
            .select(*[c for c in requests.columns if c in history.columns])
            .join(keys, MARK_KEY, "left_semi")
        ).withColumn("_turn", F.lit(0))
        rows = rows.unionByName(earlier, allowMissingColumns=True)
    settled = over_ordered_groups(
        rows, MARK_KEY, ORDER, _settle, rows_per_task=rows_per_task, count_from=count_from
    )
    return settled.filter(F.col("_turn") == 1).select(
        *requests.columns, F.col("reject_reason").isNull().alias("accepted"), "reject_reason"
    )


def split_accepted(settled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted events, rejected events with their reason)."""
    return (
        settled.filter("accepted").drop("accepted", "reject_reason"),
        settled.filter(~F.col("accepted")).drop("accepted"),
    )


def existing_marks(
    requests: DataFrame, history: DataFrame, *, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """For each request the latest earlier mark of its key with TYPE_MARK 0, as the columns
    prev_id, prev_by, prev_mark, prev_role and prev_create; NULL where there is none.

    An as-of join by one pass over both tables in order, so no request meets more than one mark.
    """
    cols = [*MARK_KEY, "DATE_CREATE", "ID"]
    marks = history.filter(F.col("TYPE_MARK") == 0).select(
        *cols,
        F.struct(
            F.col("ID").alias("prev_id"), F.col("MARKED_BY").alias("prev_by"),
            F.col("ATTENDANCE_MARK").alias("prev_mark"), F.col("MARKED_BY_ROLE").alias("prev_role"),
            F.col("DATE_CREATE").alias("prev_create"),
        ).alias("_mark"),
        F.lit(1).alias("_turn"),
    )
    asks = requests.select(*requests.columns, F.lit(0).alias("_turn"))
    both = asks.unionByName(marks, allowMissingColumns=True)

    def step(rows: DataFrame, groups: Ordered) -> DataFrame:
        return groups.carry(rows, last_before={"_prev": F.col("_mark")})

    found = over_ordered_groups(
        both, MARK_KEY, ["DATE_CREATE", "ID", "_turn"], step, rows_per_task=rows_per_task
    )
    return found.filter(F.col("_turn") == 0).select(*requests.columns, "_prev.*")


def accepted_overwrites(
    accepted: DataFrame, history: DataFrame | None = None, *, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Accepted marks that replaced another, with the mark that stood before as prev_id, prev_by,
    prev_mark, prev_role and prev_create. ``history`` are marks accepted earlier."""
    stood = accepted if history is None else accepted.unionByName(history, allowMissingColumns=True)
    return existing_marks(accepted, stood, rows_per_task=rows_per_task).filter("prev_id IS NOT NULL")

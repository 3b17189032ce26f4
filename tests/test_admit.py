from datetime import date, datetime

import pytest

from rollmark.functions.scalars import UUID_PATTERN
from pyspark.sql import functions as F

from rollmark.operators.admit import (
    School, check_access, input_reason, parse_requests, supplied_day, to_events, validate_marks,
)
from rows import as_dicts

DAY = date(2024, 3, 4)
REQUEST = (
    "request_id string, journalId string, userId string, lessonId string, attendance string, "
    "lessonDate string, requester_id bigint, requester_dean_id bigint, requester_kind string, "
    "requested_at timestamp_ntz"
)
FIELDS = [f.split()[0] for f in REQUEST.split(", ")]


def ask(id, **changes):
    base = dict(
        request_id=id, journalId="1", userId="50", lessonId="10", attendance="1", lessonDate=None,
        requester_id=900, requester_dean_id=90, requester_kind="employee",
        requested_at=datetime(2024, 3, 4, 9, 30),
    )
    return {**base, **changes}


def student(id, who, **changes):
    return ask(id, requester_id=who, requester_dean_id=None, requester_kind="student", **changes)


def frame(spark, asks):
    return spark.createDataFrame([tuple(a[f] for f in FIELDS) for a in asks], REQUEST)


@pytest.fixture(scope="module")
def school(spark):
    make = spark.createDataFrame
    pairs = "JOURNAL_ID bigint, RESPONSIBLE_ID bigint"
    return School(
        lessons=make(
            [(10, DAY, 1, False), (11, DAY, 1, True), (12, DAY, 0, False), (13, DAY, 9, False)],
            "ID bigint, DATE date, NUMBER int, BLOCKED boolean",
        ),
        responsible_teachers=make([(1, 90), (1, 90), (2, 91)], pairs),
        responsible_students=make([(1, 60), (1, 61)], pairs),
        grants=make(
            [(902, 1, "granted"), (50, 1, "group"), (60, 1, "group"), (62, 1, "granted"), (63, 2, "granted")],
            "user_id bigint, journal_id bigint, grant_kind string",
        ),
        dean_office=make([(900,)], "user_id bigint"),
    )


CASES = [
    (ask("ok"), None),
    (ask("empty", journalId=None, userId=None, lessonId=None, attendance=None), "empty"),
    (ask("m1", journalId=None, lessonId=None), "missing:journalId"),
    (ask("m2", userId=None, lessonId=None), "missing:userId"),
    (ask("m3", lessonId=None), "missing:lessonId"),
    (ask("m4", attendance=None, journalId="x"), "missing:attendance"),
    (ask("b1", journalId="0", userId="x"), "bad_journal"),
    (ask("b2", userId="-3"), "bad_user"),
    (ask("b3", lessonId="ten"), "bad_lesson"),
    (ask("b4", attendance="4"), "bad_attendance"),
    (ask("b5", attendance="yes"), "bad_attendance"),
    (ask("d1", requester_dean_id=None), "no_dean_id"),
    (ask("d2", requester_dean_id=0), "no_dean_id"),
    (ask("a1", requester_dean_id=91), "no_journal_access"),
    (ask("a2", requester_id=902, requester_dean_id=91), None),
    (ask("k1", requester_kind="guest"), "unknown_kind"),
    (ask("k2", requester_kind=None), "unknown_kind"),
    (ask("l1", lessonId="99"), "lesson_not_found"),
    (ask("l2", lessonId="11", lessonDate="2024-03-05"), "lesson_blocked"),
    (ask("l3", lessonDate="2024-03-05"), "date_mismatch"),
    (ask("l4", lessonDate="soon"), "date_mismatch"),
    (ask("l5", lessonDate="2024-03-04"), None),
    (ask("t1", requested_at=datetime(2024, 3, 4, 23, 0), lessonId="12"), None),
    (student("s1", 50), None),
    (student("s2", 50, userId="51"), "only_self"),
    (student("s3", 51, userId="51"), "no_journal_access"),
    (student("s4", 60), None),
    (student("s5", 61), "no_journal_access"),
    (student("s6", 62), None),
    (student("s7", 63), "only_self"),
    (student("c1", 50, requested_at=datetime(2024, 3, 4, 9, 0)), "outside_slot"),
    (student("c2", 50, requested_at=datetime(2024, 3, 4, 9, 0, 0, 1)), None),
    (student("c3", 50, requested_at=datetime(2024, 3, 4, 10, 30)), "outside_slot"),
    (student("c4", 50, requested_at=datetime(2024, 3, 4, 10, 40)), "outside_slot"),
    (student("c5", 50, lessonId="12"), "bad_slot"),
    (student("c6", 50, lessonId="13"), "bad_slot"),
]


@pytest.mark.parametrize("options", [{}, {"broadcast": [False] * 5, "rows_per_task": 5}])
def test_first_reason_wins(spark, school, options):
    judged = validate_marks(frame(spark, [c for c, _ in CASES]), school, **options)
    got = {r["request_id"]: r["reject_reason"] for r in as_dicts(judged.select("request_id", "reject_reason"))}
    assert got == {c["request_id"]: reason for c, reason in CASES}


def test_input_reason_alone(spark):
    empty = ask("e", journalId=None, userId=None, lessonId=None, attendance=None, lessonDate="2024-03-04")
    row = parse_requests(frame(spark, [empty])).select(input_reason().alias("r")).first()
    assert row.r == "missing:journalId"


def test_roles(spark, school):
    asks = [
        ask("dean1", attendance="1"), ask("dean2", attendance="2"), ask("dean3", attendance="3"),
        ask("emp3", requester_id=902, attendance="3"), student("monitor", 60), student("granted", 62),
        student("plain", 50), ask("guest", requester_kind="guest"),
    ]
    got = {r["request_id"]: (r["marked_by_role"], r["marked_by"]) for r in as_dicts(check_access(frame(spark, asks), school))}
    assert got == {
        "dean1": (2, 90), "dean2": (3, 90), "dean3": (3, 90), "emp3": (2, 90), "monitor": (1, 60),
        "granted": (1, 62), "plain": (0, 50), "guest": (None, 900),
    }


def test_events_of_admitted_requests(spark, school):
    judged = validate_marks(frame(spark, [ask("x"), ask("y", attendance="9"), student("z", 50)]), school)
    events = as_dicts(to_events(judged))
    assert {(e["MARKED_BY"], e["MARKED_BY_ROLE"]) for e in events} == {(90, 2), (50, 0)}
    one = events[0]
    assert one["LESSON_DATE"] == "2024-03-04" and one["DATE_CREATE"] == "2024-03-04 09:30:00.000000"
    assert one["TYPE_MARK"] == 0 and one["NUMBER_CERT"] is None
    again = as_dicts(to_events(judged))
    assert {e["ID"] for e in again} == {e["ID"] for e in events}
    import re

    assert all(re.search(UUID_PATTERN.replace(r"\z", r"\Z"), e["ID"]) for e in events)


def test_ids_that_fit_no_event_are_refused(spark):
    big = "3000000000"
    rows = [("1", "2", "3", "1"), ("1", big, "3", "1"), ("70000", "2", "3", "1"), ("1", "2", "9" * 20, "1")]
    got = spark.createDataFrame(rows, "journalId string, userId string, lessonId string, attendance string").selectExpr(
        "*", "CAST(NULL AS string) AS lessonDate")
    reasons = [r.reason for r in parse_requests(got).select(input_reason().alias("reason")).collect()]
    assert reasons == [None, "bad_user", "bad_journal", "bad_lesson"]


def test_the_whole_supplied_date_counts(spark):
    texts = ["2025-03-03", " 2025-03-03 ", "03.03.2025", "2025-03-03 10:15", "2025-03-03T10:15:59.5", "03.03.2025 10:15:00",
             "2025-03-03garbage", "2025-02-30", "3.3.2025", "2025-03-03 99:00", "", None]
    got = spark.createDataFrame([(x,) for x in texts], "x string").select(supplied_day(F.col("x")).alias("d")).collect()
    assert [r.d for r in got] == [date(2025, 3, 3)] * 6 + [None] * 6

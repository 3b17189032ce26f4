import json
from datetime import date

import pytest

from rollmark.operators.directory import flatten_directory, restrict_view, student_view, teacher_view
from rollmark.sources.directory import parse_documents
from rollmark.sources.messages import decode_events
from rows import as_dicts

GOOD = {
    "ID": "a", "JOURNAL_ID": 7, "STUDENT_ID": 101, "LESSON_ID": 9001, "LESSON_DATE": "2025-03-03",
    "ATTENDANCE_MARK": 1, "MARKED_BY": "55", "DATE_CREATE": "2025-03-03 09:05:00.123456", "TYPE_MARK": 0,
    "MARKED_BY_ROLE": 2,
}


def decode(spark, values):
    rows = [(f"k{i}", v) for i, v in enumerate(values)]
    events, rejects = decode_events(spark.createDataFrame(rows, "key string, value string"))
    return {r["ID"]: r for r in as_dicts(events)}, {r["key"]: r["reason"] for r in as_dicts(rejects)}


def test_decode(spark):
    values = [
        json.dumps(GOOD),
        json.dumps({**GOOD, "ID": "b", "MARKED_BY": 77, "LESSON_ID": 3_000_000_000}),
        json.dumps({**GOOD, "ID": "big", "MARKED_BY": 3_000_000_000}),
        json.dumps({**GOOD, "ID": "c", "MARKED_BY": 2**70, "STUDENT_ID": 5.5, "JOURNAL_ID": "x"}),
        "{bad", "", None, json.dumps({k: v for k, v in GOOD.items() if k != "ID"}), "[]",
    ]
    events, rejects = decode(spark, values)
    assert set(events) == {"a", "b", "big", "c"}
    assert events["b"]["LESSON_ID"] == events["big"]["MARKED_BY"] == 3_000_000_000
    assert events["a"]["MARKED_BY"] == 55 and events["b"]["MARKED_BY"] == 77
    assert events["a"]["NUMBER_CERT"] is None
    assert events["a"]["DATE_CREATE"] == GOOD["DATE_CREATE"]
    assert [events["c"][c] for c in ("MARKED_BY", "STUDENT_ID", "JOURNAL_ID")] == [None] * 3
    assert events["c"]["LESSON_ID"] == 9001
    assert rejects["k4"] == "malformed_json" and rejects["k5"] == "empty_value"
    assert rejects["k6"] == "no_value" and rejects["k7"] == "no_id"
    assert len(events) + len(rejects) == len(values)


STUDY = {
    "department": {"short_title": "G1"}, "specialization": {"title": "S1"}, "edu_year": "2019",
    "edu_qualification": "Q", "edu_course": "3",
}
WORK = {"job_title": "docent", "department": {"FACULTY_NAME_DECANAT": "F", "title": "K"}}


def person(key=None, kind="student", dean=None, **more):
    fields = {"fullname": f"N {key or dean}", "type": kind, **more}
    if key is not None:
        fields["BITRIX_USER_ID"] = key
    if dean is not None:
        fields["ID_DECANAT"] = dean
    return fields


def flat(spark, docs):
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "document string")
    return flatten_directory(parse_documents(df), date(2024, 2, 1))


def students(spark, *docs):
    return {r["ENRICHED_STUDENT_ID"]: r for r in as_dicts(student_view(flat(spark, docs)))}


def teachers(spark, *docs):
    return {r["ENRICHED_MARKED_BY"]: r for r in as_dicts(teacher_view(flat(spark, docs)))}


def test_students(spark):
    second = {**STUDY, "edu_year": "1999"}
    s = students(
        spark,
        {"PERSONAL": person("1", birthdate="2000-02-01T00:00:00Z", sex="f", surname="M"), "EDUCATION": [STUDY, second]},
        {"PERSONAL": person("2"), "EDUCATION": []},
        {"PERSONAL": person("3")},
        {"PERSONAL": person("4"), "EDUCATION": STUDY},
        {"PERSONAL": person("5", birthdate="soon"), "EDUCATION": [{**STUDY, "edu_year": "20x", "edu_course": ""}]},
        {"PERSONAL": person("6", birthdate=""), "EDUCATION": [{"department": None, "specialization": None}]},
        {"PERSONAL": person("7", kind="employee"), "EDUCATION": [STUDY]},
        {"PERSONAL": person("8", kind="guest"), "EDUCATION": [STUDY]},
        {"PERSONAL": person("0"), "EDUCATION": [STUDY]},
        {"PERSONAL": person(""), "EDUCATION": [STUDY]},
        {"PERSONAL": person(), "EDUCATION": None},
    )
    assert set(s) == set("12345678")
    assert s["1"]["ADMISSION_YEAR"] == 2019 and s["1"]["COURSE"] == 3 and s["1"]["STUDENT_AGE"] == 24
    assert s["1"]["GROUP_SHORT_TITLE"] == "G1" and s["1"]["SPECIALIZATION_TITLE"] == "S1"
    assert s["1"]["STUDENT_MIDDLE_NAME"] == "M" and s["1"]["QUALIFICATION"] == "Q"
    for key in "234678":
        row = {k: v for k, v in s[key].items() if k not in ("ENRICHED_STUDENT_ID", "STUDENT_FIO")}
        assert set(row.values()) == {"", 0}, key
    assert s["5"]["ADMISSION_YEAR"] == 0 and s["5"]["COURSE"] == 0 and s["5"]["STUDENT_AGE"] == 0


def test_teachers(spark):
    own = {"WORK_POSITION": "own"}
    t = teachers(
        spark,
        {"PERSONAL": person(kind="employee", dean=1, **own), "WORK": [WORK]},
        {"PERSONAL": person(kind="employee", dean=2, **own), "WORK": [{"department": {}}]},
        {"PERSONAL": person(kind="employee", dean=3, **own), "WORK": []},
        {"PERSONAL": person(kind="employee", dean=4, **own), "WORK": WORK},
        {"PERSONAL": person(kind="employee", dean=5, **own)},
        {"PERSONAL": person(kind="student", dean=6, **own), "WORK": [WORK]},
        {"PERSONAL": person(kind="employee", dean=0, **own), "WORK": [WORK]},
        {"PERSONAL": person(kind="employee", **own), "WORK": [WORK]},
    )
    positions = {k: v["TEACHER_WORK_POSITION"] for k, v in t.items()}
    assert positions == {"1": "docent", "2": "", "3": "", "4": "", "5": "own", "6": "own"}
    assert (t["1"]["FACULTY"], t["1"]["KAFEDRA"]) == ("F", "K")
    assert (t["6"]["FACULTY"], t["6"]["KAFEDRA"]) == ("", "")


def test_copies_of_a_key_leave_one_row_whatever_the_order(spark):
    docs = [{"PERSONAL": person("1", lastname=n), "EDUCATION": [STUDY]} for n in "bca"]
    assert students(spark, *docs) == students(spark, *reversed(docs))
    assert students(spark, *docs)["1"]["STUDENT_LAST_NAME"] == "c"


def test_restrict_and_empty(spark):
    view = student_view(flat(spark, [{"PERSONAL": person(k)} for k in "12"]))
    ids = spark.createDataFrame([("2",), ("2",), ("9",)], "id string")
    assert [r["ENRICHED_STUDENT_ID"] for r in restrict_view(view, ids).collect()] == ["2"]
    nobody = spark.createDataFrame([], "document string")
    assert student_view(flatten_directory(parse_documents(nobody), date(2024, 1, 1))).count() == 0

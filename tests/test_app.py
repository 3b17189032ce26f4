"""The whole way from requests to SQL over the mart, through the command line."""

from datetime import date, timedelta

import models
from rollmark import app
from rollmark.operators.directory import flatten_directory
from rollmark.plans.session import scratch_path
from rollmark.plans.views import register_views
from rollmark.schemas import RAW_COLUMNS
from rollmark.sinks.history import find_mark, read_history
from rollmark.sinks.messages import to_messages, write_messages
from rollmark.sources.directory import read_directory
from rollmark.sources.school import TABLES, read_school
from rollmark.streaming.run import supervise
from rows import frame, message, random_events

DOCUMENTS = [
    message(PERSONAL=dict(fullname=f"P{i}", type="student", BITRIX_USER_ID=str(i)),
            EDUCATION=[dict(department=dict(short_title="G"))]) for i in range(3)
] + [message(PERSONAL=dict(fullname=f"T{i}", type="employee", ID_DECANAT=i), WORK=[]) for i in range(1, 4)]


def test_from_marks_to_sql(spark):
    p = {n: scratch_path(spark, n) for n in "raw accepted rejects standing enriched history state docs".split()}
    rows = random_events(61, 80, keys=4, ties=False)
    # the generator's times reach 30 years ahead, which a watermark does not follow
    rows = [{**r, "LESSON_DATE": date(2024, 3, 5), "DATE_CREATE": r["DATE_CREATE"] - timedelta(days=32 * 366)} for r in rows]
    write_messages(to_messages(frame(spark, rows), RAW_COLUMNS).coalesce(2), "parquet", path=p["raw"])
    spark.createDataFrame([(d,) for d in DOCUMENTS], "value string").write.text(p["docs"])

    def run(job, source, *more):
        supervise(app.start(spark, [
            job, "--checkpoint", scratch_path(spark, "cp"), "--source", "parquet", "--sink", "parquet",
            "--source-option", f"path={p[source]}", *more,
        ]))

    run("settle", "raw", "--sink-option", f"path={p['accepted']}", "--table", p["standing"], "--rejects", p["rejects"])
    run("enrich", "accepted", "--sink-option", f"path={p['enriched']}", "--directory", p["docs"],
        "--directory-format", "text", "--watermark", "365 days")
    run("history", "enriched", "--table", p["history"], "--any-id")
    run("mart", "enriched", "--table", p["state"], "--any-id")

    want = models.arbitrate(rows)
    accepted = {k for k, v in want.items() if v is None}
    assert {r.ID for r in read_history(spark, p["history"]).collect()} == accepted
    assert {r.ID for r in spark.read.parquet(p["rejects"]).collect()} == set(want) - accepted

    register_views(spark, history=p["history"], state=p["state"])
    marks = spark.sql(
        "SELECT STUDENT_ID, student_fio, attendance_mark, group_short_title FROM latest_attendance_mv"
    ).collect()
    newest = models.latest([r for r in rows if r["ID"] in accepted])
    assert {(m.STUDENT_ID, m.attendance_mark) for m in marks} == {
        (r["STUDENT_ID"], r["ATTENDANCE_MARK"]) for r in newest.values()
    }
    assert {m.student_fio for m in marks} == {"P1", "P2", None}  # 0 is no usable id
    assert spark.sql("SELECT count(*) AS n FROM attendance_enriched").first().n == len(accepted)

    one = next(iter(newest.values()))
    found = find_mark(
        spark, p["history"], journal_id=1, student_id=one["STUDENT_ID"], lesson_id=10, day=date(2024, 3, 5)
    ).collect()
    assert [f.ID for f in found] == [one["ID"]]
    assert find_mark(spark, p["history"], journal_id=9, student_id=1, lesson_id=1, day=date(2024, 3, 5)).count() == 0


def test_directory_and_school_files(spark):
    text, nested = scratch_path(spark, "docs"), scratch_path(spark, "docs")
    spark.createDataFrame([(d,) for d in DOCUMENTS], "value string").write.text(text)
    read_directory(spark, text, "text").write.parquet(nested)
    flat = [flatten_directory(read_directory(spark, path, fmt), date(2024, 1, 1)) for path, fmt in ((text, "text"), (nested, "parquet"))]
    assert sorted(flat[0].collect(), key=str) == sorted(flat[1].collect(), key=str)

    root = scratch_path(spark, "school")
    filled = {
        "lessons": [(10, date(2024, 3, 4), 2, 1, False), (11, None, None, 9, True)],
        "responsible_teachers": [(1, 3_000_000_000)], "responsible_students": [(1, 60), (None, 61)],
        "grants": [(902, 1, "granted"), (60, 1, "group")], "dean_office": [(900,)],
    }
    for name, ddl in TABLES.items():
        spark.createDataFrame(filled[name], ddl).write.parquet(f"{root}/{name}")
    school = read_school(spark, root)
    assert school.lessons.columns == ["ID", "DATE", "TYPE_ID", "NUMBER", "BLOCKED"]
    for name in TABLES:
        assert sorted((tuple(r) for r in getattr(school, name).collect()), key=str) == sorted(filled[name], key=str)

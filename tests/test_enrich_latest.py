from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import models
from rollmark.operators import latest, reports
from rollmark.operators.conform import conform_enriched
from rollmark.operators.dedupe import dedupe_events, duplicate_report
from rollmark.operators.enrich import (
    enrich_events, enrichment_hits, lookup_ids, missing_lookup_ids, with_people,
)
from rollmark.operators.metrics import observe_stage, sample_rows
from rollmark.schemas import MART_COLUMNS, OUTPUT_COLUMNS, STUDENT, TEACHER
from rows import as_dicts, enriched, event, frame, random_events


def people(spark, students=(), teachers=()):
    s = [(k, f"S{k}", "", "", "", 0, "", 0, "", 0, "G", "") for k in students]
    t = [(k, f"T{k}", "", "", "", "", "F", "K", 0, "") for k in teachers]
    return spark.createDataFrame(s, STUDENT), spark.createDataFrame(t, TEACHER)


@pytest.mark.parametrize("broadcast", [None, (True, False), (False, True), (False, False)])
@pytest.mark.parametrize("rows_per_task", [5_000_000, 7])
def test_enrich_is_the_same_by_every_strategy(spark, broadcast, rows_per_task):
    rows = [event(i, student=5 if i % 3 else i, by=i % 4, role=[0, 1, 2, 3, None][i % 5]) for i in range(60)]
    rows += [{**event(f"n{i}"), "STUDENT_ID": None, "MARKED_BY": None} for i in range(20)]
    s, t = people(spark, ["5", "6", "9"], ["1", "2"])
    out = enrich_events(frame(spark, rows), s, t, broadcast=broadcast, rows_per_task=rows_per_task)
    assert out.columns == OUTPUT_COLUMNS
    found = {r["ID"]: r for r in as_dicts(out)}
    assert len(found) == out.count() == len(rows)
    for r in rows:
        got = found[r["ID"]]
        known = str(r["STUDENT_ID"]) in ("5", "6", "9")
        assert got["STUDENT_FIO"] == (f"S{r['STUDENT_ID']}" if known else None)
        assert got["STUDENT_LAST_NAME"] == ("" if known else None)
        assert got["STUDENT_AGE"] == (0 if known else None)
        taught = r["MARKED_BY_ROLE"] in (2, 3) and r["MARKED_BY"] in (1, 2)
        assert got["TEACHER_FIO"] == (f"T{r['MARKED_BY']}" if taught else None)


def test_lookup_ids_and_counts(spark):
    rows = [
        event(1, student=5, by=1, role=2), event(2, student=6, by=2, role=0), event(3, student=5, by=3, role=3),
        {**event(4, by=4, role=None), "STUDENT_ID": None},
    ]
    events = frame(spark, rows)
    s, t = people(spark, ["5"], ["1"])
    assert {tuple(r) for r in lookup_ids(events).collect()} == {
        ("student", "5"), ("student", "6"), ("teacher", "1"), ("teacher", "3")
    }
    assert {tuple(r) for r in missing_lookup_ids(events, s, t).collect()} == {("student", "6"), ("teacher", "3")}
    assert enrichment_hits(events, s, t).first().asDict() == dict(
        events=4, student_found=2, student_missing=1, teacher_found=1, teacher_missing=1
    )
    assert with_people(events, *people(spark)).filter("student_found or teacher_found").count() == 0


def test_dedupe_and_report(spark):
    rows = [event("a", at=5), event("a", at=3, mark=0), event("a", at=3, mark=1), event("b"), event("b")]
    events = frame(spark, rows)
    assert {tuple(r) for r in duplicate_report(events).collect()} == {("a", 3), ("b", 2)}
    kept = {r["ID"]: r for r in as_dicts(dedupe_events(events))}
    assert len(kept) == dedupe_events(events).count() == 2
    assert kept["a"]["ATTENDANCE_MARK"] == 0
    assert dedupe_events(events).columns == events.columns


def test_latest_forms_agree_with_the_model(spark):
    rows = random_events(21, 300, keys=20)
    want = {k: r["ID"] for k, r in models.latest(rows).items()}
    df = enriched(spark, rows)
    for form in (latest.latest_rows, latest.latest_rows_window):
        got = {tuple(r[k] for k in models.KEY): r["ID"] for r in as_dicts(form(df))}
        assert got == want
    once = latest.latest_rows(df)
    assert sorted(latest.latest_rows(once).collect()) == sorted(once.collect())
    for cut in (40, 150, 299):
        old, new = enriched(spark, rows[:cut]), enriched(spark, rows[cut:])
        for a, b in ((old, new), (new, old)):
            assert sorted(latest.merge_latest(latest.latest_rows(a), b).collect()) == sorted(once.collect())
    assert latest.latest_marks(df).columns == MART_COLUMNS and len(MART_COLUMNS) == 30


def test_latest_whole_row_or_per_column(spark):
    rows = [event("a", at=1), event("b", at=2, mark=0, type_mark=1), event("c", at=2, mark=2)]
    df = enriched(spark, rows).withColumn("STUDENT_FIO", F.when(F.col("ID") == "a", "x"))
    whole, per_column = latest.latest_marks(df).first(), latest.latest_non_null(df).first()
    assert (whole.attendance_mark, whole.student_fio) == (2, None)
    assert (per_column.attendance_mark, per_column.student_fio) == (2, "x")
    assert latest.latest_marks_window(df).first() == whole


def mart(spark, rows):
    return latest.latest_marks(enriched(spark, rows)).drop("teacher_fio", "kafedra", "group_short_title", "student_fio").withColumns(
        {
            "teacher_fio": F.when(F.col("marked_by_role") >= 2, F.concat(F.lit("T"), "marked_by")),
            "kafedra": F.lit("K"),
            "group_short_title": F.when(F.col("STUDENT_ID") < 3, "G1").otherwise("G2"),
            "student_fio": F.concat(F.lit("S"), "STUDENT_ID"),
        }
    )


def test_reports(spark):
    rows = [
        event(1, student=1, mark=1), event(2, student=2, mark=0), event(3, student=3, mark=2, by=8),
        event(4, student=4, mark=3, by=8), event(5, student=4, mark=1, role=0, by=4, lesson=11),
        event(6, student=1, mark=1, lesson=12, day=date(2024, 3, 5)), event(7, student=1, mark=1, lesson=13),
    ]
    m = mart(spark, rows)
    assert {tuple(r) for r in reports.marks_by_group(m).collect()} == {
        ("G1", 1, 3), ("G1", 0, 1), ("G2", 2, 1), ("G2", 3, 1), ("G2", 1, 1)
    }
    assert {tuple(r) for r in reports.marks_by_group(m, ["G1"]).collect()} == {("G1", 1, 3), ("G1", 0, 1)}
    assert (4, "S4", "G2", 1, 0) in {tuple(r) for r in reports.student_attendance(m).collect()}
    assert reports.marks_on_date(m, date(2024, 3, 4)).first()[0] == 6
    assert reports.marks_on_date(m, date(2024, 3, 4), ["G2"]).first()[0] == 3
    assert (8, "T8", 2, 1) in {tuple(r) for r in reports.marks_by_teacher(m).collect()}
    pct = {r.teacher_fio: r for r in reports.teacher_attendance_pct(m).collect()}
    assert (pct["T7"].present_pct, pct["T7"].absent_pct) == (75.0, 25.0)
    assert (pct["T8"].marks, pct["T8"].present_pct, pct["T8"].absent_pct) == (2, None, None)
    assert set(pct) == {"T7", "T8"}
    nothing = m.filter(F.lit(False))
    assert reports.marks_by_group(nothing).count() == 0 and reports.teacher_attendance_pct(nothing).count() == 0
    assert reports.marks_on_date(nothing, date(2024, 3, 4)).first()[0] == 0


def test_conform(spark):
    uuid = "6F1C1b2a-0000-4000-8000-00000000000"
    base = enriched(spark, [event(i) for i in range(7)])
    n = F.col("ID").cast("int")
    df = base.withColumns(
        {
            "ID": F.when(n == 1, "no uuid").otherwise(F.concat(F.lit(uuid), "ID")),
            "LESSON_DATE": F.when(n == 2, "2024-13-01").otherwise("2024-03-04"),
            "DATE_CREATE": F.when(n == 3, "then").otherwise("2024-03-04 01:05:00.123456"),
            "JOURNAL_ID": F.when(n == 4, 70000).otherwise(F.col("JOURNAL_ID")),
            "TYPE_MARK": F.when(n == 5, 256).otherwise(F.col("TYPE_MARK")),
            "ATTENDANCE_MARK": F.when(n == 6, -1).otherwise(1),
        }
    )
    good, bad = conform_enriched(df)
    rows = {r["ID"][-1]: r for r in as_dicts(good)}
    assert set(rows) == {"0", "5"}
    assert rows["0"]["ID"] == uuid.lower() + "0"
    assert str(rows["0"]["DATE_CREATE"]) == "2024-03-03 22:05:00.123000"
    assert rows["0"]["LESSON_DATE"] == date(2024, 3, 4)
    assert rows["5"]["TYPE_MARK"] is None
    assert sorted(r["reason"] for r in as_dicts(bad)) == sorted(
        ["ID", "LESSON_DATE", "DATE_CREATE", "JOURNAL_ID", "ATTENDANCE_MARK"]
    )


def test_observed_counts(spark):
    rows, seen = observe_stage(frame(spark, [event(i) for i in range(9)]), marks=F.sum("ATTENDANCE_MARK"))
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 9, "marks": 9}
    assert sample_rows(frame(spark, [event(i) for i in range(9)])).count() == 2

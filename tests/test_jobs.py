"""Jobs that judge, count and watch: admission, figures, late rows, failing queries."""

import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rollmark import app
from rollmark.operators import latest, reports
from rollmark.operators.metrics import observe_stage, sampled_ids
from rollmark.plans.session import scratch_path
from rollmark.schemas import MARK_KEY, MART_VALUES
from rollmark.sinks.files import exists
from rollmark.sinks.latest import compact_non_null, read_mart, read_non_null, upsert_non_null
from rollmark.sinks.messages import to_messages, write_messages
from rollmark.sources.messages import MESSAGE, decode_requests
from rollmark.sources.school import TABLES
from rollmark.streaming.admission import SchoolSnapshots
from rollmark.streaming.figures import CELLS, read_report, start_figures, table as figures_table
from rollmark.streaming.run import start_batches, supervise
from rollmark.streaming.settlement import settle_batch
from rows import enriched, event, frame, message, random_events
from test_admit import ask, school, student  # noqa: F401
from test_store import stored
from test_streaming import put, run_enrichment, source, text


def as_message(request):
    return message(**{**request, "requested_at": str(request["requested_at"])})


def test_requests_are_decoded_field_by_field(spark):
    good = ask("a", requester_id="902", lessonDate="04.03.2024")
    values = [as_message(good), as_message(ask("b", requester_id="many")), "{bad", None, message(userId="5")]
    requests, rejects = decode_requests(spark.createDataFrame([(v,) for v in values], "value string"))
    got = {r.request_id: r for r in requests.collect()}
    assert got["a"].requester_id == 902 and got["a"].requested_at == datetime(2024, 3, 4, 9, 30)
    assert got["a"].lessonDate == "04.03.2024" and got["b"].requester_id is None
    assert sorted(r.reason for r in rejects.collect()) == ["malformed_json", "no_id", "no_value"]


def test_a_batch_done_again_is_judged_by_the_tables_of_the_first_time(spark, school):  # noqa: F811
    """The lesson is blocked between the two runs of a batch."""
    root, now, tables = scratch_path(spark, "school"), [0.0], [school]
    blocked = school.lessons.withColumn("BLOCKED", F.lit(True))

    def judged(snapshots, batch):
        lessons = snapshots.of_batch(spark, "run", batch)[0].lessons
        return lessons.filter("ID = 10").first().BLOCKED

    first = SchoolSnapshots(lambda s: tables[0], root, 60, clock=lambda: now[0])
    assert judged(first, 0) is False
    tables[0] = type(school)(**{**school.__dict__, "lessons": blocked})
    assert judged(first, 1) is False  # not yet refreshed
    again = SchoolSnapshots(lambda s: tables[0], root, 60, clock=lambda: now[0])
    assert judged(again, 1) is False and judged(again, 0) is False
    assert judged(again, 2) is True
    now[0] = 61
    assert judged(again, 2) is True and judged(again, 3) is True
    assert judged(again, 4) is True
    ties = again._ties(spark, "run")
    assert sorted(ties) == [3, 4] and exists(spark, f"{root}/{ties[3]}/lessons")


def test_admission_job_from_requests_to_messages(spark, school):  # noqa: F811
    p = {n: scratch_path(spark, n) for n in "asks school out rejects standing cp".split()}
    for name, ddl in TABLES.items():
        rows = getattr(school, name)
        there = [c.split()[0] for c in ddl.split(", ")]
        rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("int").alias(c) for c in there]).write.parquet(
            f"{p['school']}/{name}")
    first = [ask("r1", requester_id=902), ask("r2", requester_id=1, requester_dean_id=5), ask("r3", lessonId="11")]
    later = [student("r4", 50, requested_at=datetime(2024, 3, 4, 9, 40)), ask("r5", requester_id=902, attendance="2")]
    put(spark, p["asks"], [as_message(a) for a in first] + ["{bad"])
    put(spark, p["asks"], [as_message(a) for a in later])
    supervise(app.start(spark, [
        "admit", "--checkpoint", p["cp"], "--source", "parquet", "--sink", "parquet", "--source-option", f"path={p['asks']}",
        "--source-option", "maxFilesPerTrigger=1", "--sink-option", f"path={p['out']}", "--school", p["school"],
        "--table", p["standing"], "--rejects", p["rejects"],
    ]))
    sent = spark.read.schema(MESSAGE).parquet(p["out"])
    marks = sent.select(F.get_json_object("value", "$.ATTENDANCE_MARK").alias("m")).collect()
    assert sorted(r.m for r in marks) == ["1", "2"]
    refused = {r.request_id: r.reject_reason for r in spark.read.parquet(f"{p['rejects']}-refused").collect()}
    assert refused == {"r2": "no_journal_access", "r3": "lesson_blocked"}
    assert [r.reject_reason for r in spark.read.parquet(p["rejects"]).collect()] == ["teacher_mark"]
    assert [r.reason for r in spark.read.parquet(f"{p['rejects']}-unread").collect()] == ["malformed_json"]
    assert exists(spark, f"{p['cp']}-school/ties")


def test_a_job_ends_when_one_of_its_queries_fails(spark):
    path = scratch_path(spark, "in")
    put(spark, path, [message(**text(event("a")))])

    def fails(rows, batch_id):
        raise OSError("the directory is down")

    lasting = start_batches(source(spark, path), lambda rows, i: None, scratch_path(spark, "cp"), every="1 second")
    failing = start_batches(source(spark, path), fails, scratch_path(spark, "cp"), every="1 second")
    begun = time.monotonic()
    with pytest.raises(Exception, match="directory is down"):
        supervise([lasting, failing])
    assert not lasting.isActive and not failing.isActive and time.monotonic() - begun < 30
    done = start_batches(source(spark, path), lambda rows, i: None, scratch_path(spark, "cp"))
    supervise([done])
    assert not done.isActive


def test_late_rows_are_counted(spark):
    path, out, counts = scratch_path(spark, "in"), scratch_path(spark, "out"), []
    put(spark, path, [message(**text(event("a", at=3 * 86400)))])
    put(spark, path, [message(**text(event("b", at=3 * 86400 + 1)))])
    put(spark, path, [message(**text(event(f"late{k}", at=k))) for k in range(3)])
    got = run_enrichment(
        spark, path, out, scratch_path(spark, "cp"), watermark="1 day", on_metrics=lambda i, m: counts.append((i, m)))
    assert sorted(r["ID"] for r in got) == ["a", "b"]
    for _ in range(50):
        late = {i: m["late"] for i, m in counts if "late" in m}
        if sum(late.values()):
            break
        time.sleep(0.2)
    assert late[2] == 3 and sum(late.values()) == 3
    seen = [m for _, m in counts if "rows" in m]
    assert sum(m["rows"] for m in seen) == 2 and seen[0]["missing_teachers"] == []


def test_a_sample_of_ids_is_bounded_and_the_same_for_any_partitioning(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 50 != 0, F.col("id") % 700).alias("id"))
    seen = []
    for parts in (1, 7):
        observed, sample = observe_stage(rows.repartition(parts), ids=sampled_ids(F.col("id"), F.col("id") > 100))
        observed.write.format("noop").mode("overwrite").save()
        seen.append(sample.get["ids"])
    assert seen[0] == seen[1] and len(set(seen[0])) == 10 and all(int(i) > 100 for i in seen[0])
    none, sample = observe_stage(rows.limit(0), ids=sampled_ids(F.col("id"), F.lit(True)))
    none.write.format("noop").mode("overwrite").save()
    assert sample.get["ids"] == []


def test_each_columns_latest_value_over_batches(spark):
    path = scratch_path(spark, "parts")
    rows = random_events(71, 60, keys=3, ties=False)
    rows = [{**r, "MARKED_BY_ROLE": r["MARKED_BY_ROLE"] if i % 3 else None, "MARKED_BY": r["MARKED_BY"] or 0} for i, r in enumerate(rows)]
    whole = stored(spark, rows)
    want = latest.latest_non_null(whole)
    for k, part in enumerate((rows[40:], rows[:30], rows[20:40], rows[:10])):
        upsert_non_null(stored(spark, part), path, "run", k)
        if k == 1:
            compact_non_null(spark, path)
    got = read_non_null(spark, path)
    assert got.columns == MARK_KEY + [c.lower() for c in MART_VALUES]
    assert sorted(got.collect(), key=str) == sorted(want.select(*got.columns).collect(), key=str)


def test_figures_equal_the_reports_after_every_batch(spark):
    path, state, figures, cp = (scratch_path(spark, n) for n in ("in", "state", "figures", "cp"))
    rows = [{**r, "MARKED_BY": r["MARKED_BY"] + 1, "LESSON_DATE": date(2024, 3, 4 + i % 2)}
            for i, r in enumerate(random_events(81, 90, keys=6, ties=False))]
    people = lambda part: enriched(spark, part).withColumns({
        "GROUP_SHORT_TITLE": F.when(F.col("STUDENT_ID") % 3 > 0, F.concat(F.lit("G"), F.col("STUDENT_ID") % 2)),
        "STUDENT_FIO": F.concat(F.lit("S"), F.col("STUDENT_ID")),
        "TEACHER_FIO": F.when(F.col("MARKED_BY_ROLE") >= 2, F.concat(F.lit("T"), F.col("MARKED_BY"))),
        "KAFEDRA": F.when(F.col("MARKED_BY") > 1, F.lit("K")),
    })
    for part in (rows[:40], rows[30:60], rows[60:], rows[:5]):
        write_messages(to_messages(people(part)).coalesce(1), "parquet", path=path)
    checked = []

    def compare(batch_id):
        mart = read_mart(spark, state)
        day = date(2024, 3, 4)
        for name in CELLS:
            more = {"as_of": day} if name == "marks_on_date" else {}
            want = getattr(reports, name)(mart, *more.values())
            got = read_report(spark, figures, name, **more)
            assert sorted(got.collect(), key=str) == sorted(want.select(*got.columns).collect(), key=str), name
        checked.append(batch_id)

    start_figures(source(spark, path), state, figures, cp, uuid_ids=False, on_batch_done=compare, merge_every=2).awaitTermination()
    assert checked == [0, 1, 2, 3]
    assert read_mart(spark, state).count() == len({tuple(r[k] for k in MARK_KEY) for r in rows})
    assert figures_table(figures).view(spark).version > 0


def test_a_day_outside_the_range_is_refused(spark):
    seen = {}

    def sink(accepted, rejected, batch_id):
        seen.update({r.ID: None for r in accepted.collect()})
        seen.update({r.ID: r.reject_reason for r in rejected.collect()})

    rows = [event(1), event(2, day=date(9999, 1, 1)), event(3, day=date(1970, 1, 1)), event(4, day=None)]
    settle_batch(frame(spark, rows), scratch_path(spark, "standing"), 0, sink)
    assert seen == {"1": None, "2": "bad_day", "3": "bad_day", "4": "no_key"}


def test_faculty_rollup(spark):
    rows = [event(1, student=1, mark=1), event(2, student=2, mark=0), event(3, student=3, mark=2), event(4, student=4, mark=1, by=8)]
    mart = latest.latest_marks(enriched(spark, rows).withColumns({
        "TEACHER_FIO": F.lit("T"), "FACULTY": F.lit("F"), "KAFEDRA": F.when(F.col("MARKED_BY") == 8, "K2").otherwise("K1")}))
    got = {(r.faculty, r.kafedra, r.level): (r.marks, r.present_pct) for r in reports.faculty_rollup(mart).collect()}
    assert got == {
        ("F", "K1", 0): (3, 50.0), ("F", "K2", 0): (1, 100.0), ("F", None, 1): (4, pytest.approx(200 / 3)),
        (None, None, 3): (4, pytest.approx(200 / 3)),
    }
    assert reports.faculty_rollup(mart.limit(0)).filter("marks > 0").count() == 0

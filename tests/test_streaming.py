from datetime import date

import pytest
from pyspark.sql import functions as F

import models
from rollmark.operators import latest
from rollmark.operators.arbitrate import arbitrate_marks
from rollmark.plans.session import scratch_path
from rollmark.schemas import STORE_COLUMNS
from rollmark.sinks.history import read_history
from rollmark.sinks.latest import read_state
from rollmark.sinks.messages import to_messages, write_messages
from rollmark.sources.directory import parse_documents
from rollmark.sources.messages import MESSAGE, read_messages
from rollmark.streaming.arbitration import arbitrate_stream
from rollmark.streaming.enrichment import dedupe_stream, start_enrichment, start_rejects
from rollmark.streaming.run import start_batches
from rollmark.streaming.settlement import settle_batch, start_settlement
from rollmark.streaming.snapshot import DirectorySnapshot
from rollmark.streaming.store import decode_enriched, start_history, start_mart
from rows import EVENT, as_dicts, enriched, event, frame, message, random_events

DOCUMENTS = [
    message(PERSONAL=dict(fullname="Ann", type="student", BITRIX_USER_ID="5"), EDUCATION=[]),
    message(PERSONAL=dict(fullname="Tom", type="employee", ID_DECANAT=7), WORK=[]),
]


def directory(spark):
    return parse_documents(spark.createDataFrame([(d,) for d in DOCUMENTS], "document string"))


def text(r):
    return {**r, "LESSON_DATE": str(r["LESSON_DATE"]), "DATE_CREATE": r["DATE_CREATE"].strftime("%Y-%m-%d %H:%M:%S.%f")}


def put(spark, path, values):
    """One more file of messages."""
    spark.createDataFrame([(f"k{i}", v) for i, v in enumerate(values)], MESSAGE).coalesce(1).write.mode(
        "append"
    ).parquet(path)


def source(spark, path, schema=MESSAGE):
    return read_messages(spark, "parquet", stream=True, schema=schema, path=path, maxFilesPerTrigger="1")


def run_enrichment(spark, path, out, checkpoint, **options):
    query = start_enrichment(
        source(spark, path), DirectorySnapshot(directory),
        lambda rows, batch_id: write_messages(rows, "parquet", batch_id=batch_id, path=out), checkpoint, **options,
    )
    query.awaitTermination()
    return as_dicts(decode_enriched(spark.read.schema(MESSAGE).parquet(out)))


@pytest.mark.parametrize("options", [{}, {"watermark": "1 day"}])
def test_enrichment_over_files_and_restart(spark, options):
    path, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    rows = [message(**text(event(i, at=i, by=7 if i % 2 else 8, student=4 + i % 2))) for i in range(12)]
    put(spark, path, rows[:6] + ["{bad", message(JOURNAL_ID=1)])
    put(spark, path, rows[3:9])
    counts = []
    first = run_enrichment(spark, path, out, checkpoint, on_metrics=lambda i, m: counts.append(m), **options)
    assert sorted(int(r["ID"]) for r in first) == list(range(9))
    counts = [m for m in counts if "rows" in m]  # reports of late rows come beside
    assert sum(m["rows"] for m in counts) == 9 and sum(m["teacher_found"] for m in counts) == 4
    put(spark, path, rows)
    done = run_enrichment(spark, path, out, checkpoint, **options)
    assert sorted(int(r["ID"]) for r in done) == list(range(12))
    for r in done:
        odd = int(r["ID"]) % 2 == 1
        assert r["STUDENT_FIO"] == ("Ann" if odd else None) and r["TEACHER_FIO"] == ("Tom" if odd else None)

    rejects = scratch_path(spark, "rejects")
    start_rejects(
        source(spark, path), lambda df, i: df.write.mode("append").parquet(rejects), scratch_path(spark, "cp")
    ).awaitTermination()
    assert sorted(r.reason for r in spark.read.parquet(rejects).collect()) == ["malformed_json", "no_id"]


def test_late_rows_are_dropped_with_a_watermark(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    put(spark, path, [message(**text(event("a", at=3 * 86400)))])
    put(spark, path, [message(**text(event("b", at=3 * 86400 + 1)))])
    put(spark, path, [message(**text(event("late", at=0))), message(**text(event("a", at=3 * 86400)))])
    got = run_enrichment(spark, path, out, scratch_path(spark, "cp"), watermark="1 day")
    assert sorted(r["ID"] for r in got) == ["a", "b"]


def test_failing_directory_stops_the_query_and_nothing_is_lost(spark):
    path, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    put(spark, path, [message(**text(event("a")))])

    def broken(_):
        raise OSError("directory is down")

    query = start_enrichment(source(spark, path), DirectorySnapshot(broken), lambda rows, i: None, checkpoint)
    with pytest.raises(Exception, match="directory is down"):
        query.awaitTermination()
    assert [r["STUDENT_FIO"] for r in run_enrichment(spark, path, out, checkpoint)] == ["Ann"]


def test_snapshot_is_refreshed(spark):
    now, loads = [0.0], []

    def load(s):
        loads.append(1)
        return directory(s)

    snapshot = DirectorySnapshot(load, 3600, clock=lambda: now[0], today=lambda: date(2024, 1, 1))
    first = snapshot.current(spark)
    now[0] = 3600
    assert snapshot.current(spark) is first and first.broadcast == (True, True)
    now[0] = 3601
    assert snapshot.current(spark) is not first and len(loads) == 2


def test_dedupe_alone(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    for _ in range(3):
        frame(spark, [event(i % 5) for i in range(50)]).write.mode("append").parquet(path)
    start_batches(
        dedupe_stream(source(spark, path, EVENT)),
        lambda df, i: df.write.mode("append").parquet(out), scratch_path(spark, "cp"),
    ).awaitTermination()
    assert sorted(r.ID for r in spark.read.parquet(out).collect()) == list("01234")


def test_history_and_mart_over_batches_and_replay(spark):
    rows = [{**r, "LESSON_DATE": date(2024, 1 + i % 3, 5)} for i, r in enumerate(random_events(41, 90, keys=4, ties=False))]
    rows = [{**r, "MARKED_BY": r["MARKED_BY"] + 1} for r in rows]
    path, history, state = (scratch_path(spark, n) for n in ("in", "history", "state"))
    for part in (rows[:30], rows[20:60], rows[60:]):
        write_messages(to_messages(enriched(spark, part)).coalesce(1), "parquet", path=path)
    for _ in range(2):  # the second run starts from a new checkpoint and sees everything again
        start_history(source(spark, path), history, scratch_path(spark, "cp"), uuid_ids=False).awaitTermination()
        start_mart(source(spark, path), state, scratch_path(spark, "cp"), uuid_ids=False).awaitTermination()
    kept = read_history(spark, history)
    assert sorted(r.ID for r in kept.collect()) == sorted(r["ID"] for r in rows)
    want = latest.latest_rows(kept.select(*STORE_COLUMNS))
    assert sorted(read_state(spark, state).collect()) == sorted(want.select(*STORE_COLUMNS).collect())


def arbitrate_files(spark, parts, history=None):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    for part in parts:
        frame(spark, part).coalesce(1).write.mode("append").parquet(path)
    start_batches(
        arbitrate_stream(source(spark, path, EVENT), history).select("ID", "reject_reason"),
        lambda df, i: df.write.mode("append").parquet(out), scratch_path(spark, "cp"),
    ).awaitTermination()
    return {r.ID: r.reject_reason for r in spark.read.parquet(out).collect()}


def test_arbitration_in_one_or_many_files(spark):
    rows = sorted(random_events(51, 120, keys=5), key=lambda r: (r["DATE_CREATE"], r["ID"]))
    batch = {r["ID"]: r["reject_reason"] for r in as_dicts(arbitrate_marks(frame(spark, rows)))}
    assert batch == models.arbitrate(rows)
    assert arbitrate_files(spark, [rows]) == batch
    assert arbitrate_files(spark, [rows[:50], rows[50:90], rows[90:]]) == batch


def test_arbitration_starts_from_history(spark):
    rows = random_events(52, 60, keys=4)
    old = [event(f"h{k}", at=-100, by=k % 3, role=k % 4, student=k) for k in range(3)]
    assert arbitrate_files(spark, [rows], frame(spark, old)) == models.arbitrate(rows, old)


def settle_files(spark, parts, rows_per_task=5_000_000, state=None):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    for part in parts:
        frame(spark, part).coalesce(1).write.mode("append").parquet(path)

    def sink(accepted, rejected, batch_id):
        rows = accepted.selectExpr("ID", "CAST(NULL AS STRING) AS reject_reason").unionByName(
            rejected.select("ID", "reject_reason")
        )
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    start_settlement(
        source(spark, path, EVENT), state or scratch_path(spark, "standing"), sink, scratch_path(spark, "cp"),
        rows_per_task=rows_per_task,
    ).awaitTermination()
    return {r.ID: r.reject_reason for r in spark.read.parquet(out).collect()}


@pytest.mark.parametrize("rows_per_task", [5_000_000, 15])
def test_settlement_in_one_or_many_files(spark, rows_per_task):
    rows = sorted(random_events(53, 120, keys=5), key=lambda r: (r["DATE_CREATE"], r["ID"]))
    want = models.arbitrate(rows)
    assert settle_files(spark, [rows], rows_per_task) == want
    assert settle_files(spark, [rows[:50], rows[50:90], rows[90:]], rows_per_task) == want


def test_settling_a_batch_again_gives_the_same(spark):
    rows = sorted(random_events(54, 90, keys=4), key=lambda r: (r["DATE_CREATE"], r["ID"]))
    want, state, got = models.arbitrate(rows), scratch_path(spark, "standing"), {}

    def sink(accepted, rejected, batch_id):
        got.update({r.ID: None for r in accepted.collect()})
        got.update({r.ID: r.reject_reason for r in rejected.collect()})

    for batch_id, part in ((0, rows[:40]), (1, rows[40:70]), (1, rows[40:70]), (2, rows[70:]), (2, rows[70:])):
        settle_batch(frame(spark, part), state, batch_id, sink)
        assert all(want[k] == v for k, v in got.items())
    assert got == want


def test_watermark_ignores_unusable_times(spark):
    path, out, cp = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    rows = [text(event(i, at=i)) for i in range(4)]
    put(spark, path, [message(**r) for r in rows[:2]] + [message(**{**text(event(7)), "DATE_CREATE": "2999-01-01 00:00:00"})])
    put(spark, path, [message(**r) for r in rows[2:]] + [message(**{**text(event(9)), "DATE_CREATE": "soon"})])
    got = run_enrichment(spark, path, out, cp, watermark="1 day")
    assert sorted(int(r["ID"]) for r in got) == [0, 1, 2, 3]
    rejects = scratch_path(spark, "rejects")
    start_rejects(
        source(spark, path), lambda df, i: df.write.mode("append").parquet(rejects), scratch_path(spark, "cp"), watermark="1 day"
    ).awaitTermination()
    assert sorted((r.key, r.reason) for r in spark.read.parquet(rejects).collect()) == [("7", "bad_time"), ("9", "bad_time")]


def test_a_fresh_run_keeps_standing_marks(spark):
    state, seen = scratch_path(spark, "state"), {}

    def sink(accepted, rejected, batch_id):
        seen.update({r.ID: None for r in accepted.collect()})
        seen.update({r.ID: r.reject_reason for r in rejected.collect()})

    teacher = event(1, at=1, by=50, role=2, mark=1)
    student = event(2, at=2, by=5, role=0, mark=0)
    settle_batch(frame(spark, [teacher]), state, 0, sink, run="one")
    settle_batch(frame(spark, [student]), state, 0, sink, run="two")
    assert seen == {"1": None, "2": "teacher_mark"}
    settle_batch(frame(spark, [{**student, "ID": "3", "LESSON_DATE": None}]), state, 1, sink, run="two")
    assert seen["3"] == "no_key"

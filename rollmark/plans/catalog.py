"""Every operator as a query over the shared test tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rollmark.functions.scalars import age_on, stable_id
from rollmark.operators import admit, arbitrate, latest, reports
from rollmark.operators.conform import conform_enriched
from rollmark.operators.dedupe import dedupe_events, duplicate_report
from rollmark.operators.directory import restrict_view
from rollmark.operators.enrich import (
    STUDENT_KEY, TEACHER_KEY, enrich_events, enrichment_hits, lookup_ids, missing_lookup_ids, with_people,
)
from rollmark.operators.metrics import observe_stage, sampled_ids
from rollmark.plans.pipelines import admit_and_settle
from rollmark.plans.session import cut, scratch_path
from rollmark.plans.skew import lookup_join
from rollmark.schemas import (
    ENRICHED_EVENT, MARK_KEY, OUTPUT_COLUMNS, RAW_COLUMNS, STORE, STUDENT_COLUMNS,
    TEACHER_COLUMNS,
)
from rollmark.sinks import history as history_sink
from rollmark.sinks import latest as latest_sink
from rollmark.sinks.messages import to_messages, write_messages
from rollmark.sources import canonical as c
from rollmark.sources.messages import MESSAGE, decode_events, decode_requests, read_messages
from rollmark.streaming.admission import SchoolSnapshots, start_admission
from rollmark.streaming.enrichment import dedupe_stream, start_enrichment, start_rejects
from rollmark.streaming.settlement import start_settlement
from rollmark.streaming.daily import read_daily_marks, start_daily_marks
from rollmark.streaming.figures import read_report, start_figures
from rollmark.streaming.run import query_id, start_batches
from rollmark.streaming.snapshot import DirectorySnapshot
from rollmark.streaming.store import decode_enriched, start_history, start_mart, store_rows

Query = Callable[[SparkSession, str], DataFrame]

REPORT_DAY = date(2024, 1, 15)
REPORT_GROUPS = ["BUILDING", "MACHINERY"]


def group_marks(spark: SparkSession, d: str) -> DataFrame:
    """Marks per group and value, latest state only. Reduces to the latest mark before looking
    anyone up, so only one row per key carries attributes."""
    marks = latest.latest_rows(c.valid_marks(c.raw_events(spark, d)))
    people = c.lookups(spark, d)
    groups = people["students"].select(
        STUDENT_KEY, F.col("GROUP_SHORT_TITLE").alias("group_short_title")
    )
    keyed = marks.select(
        "ID", F.col("ATTENDANCE_MARK").alias("attendance_mark"),
        F.col("STUDENT_ID").cast("string").alias(STUDENT_KEY),
    )
    return reports.marks_by_group(
        lookup_join(keyed, groups, [STUDENT_KEY], broadcast=people["broadcast"][0], row_id=["ID"])
    )


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    return enrich_events(c.valid_marks(c.raw_events(spark, d)), **c.lookups(spark, d))


def _mart(spark: SparkSession, d: str) -> DataFrame:
    """Lookups have one row per key, so the latest marks are found before they are looked up: the
    shuffle carries raw columns only."""
    marks = latest.latest_rows(c.valid_marks(c.raw_events(spark, d)))
    return latest.to_mart(enrich_events(marks, **c.lookups(spark, d)))


def _doubled(raw: DataFrame) -> DataFrame:
    """The events with every third of them repeated, the copies a minute later."""
    later = raw.filter(F.col("ID").cast("bigint") % 3 == 0).withColumn(
        "DATE_CREATE", F.col("DATE_CREATE") + F.expr("INTERVAL 1 MINUTE")
    )
    return raw.unionByName(later)


# --- decode, dedupe, directory ----------------------------------------------------------------


def decode_props(spark, d):
    events, _ = decode_events(c.to_messages(c.raw_events(spark, d)))
    return events


def decode_rejects(spark, d):
    _, rejects = decode_events(c.to_messages(c.raw_events(spark, d)))
    return rejects.select("key", "reason")


def duplicates(spark, d):
    return duplicate_report(_doubled(c.raw_events(spark, d)))


def deduped(spark, d):
    return dedupe_events(_doubled(c.raw_events(spark, d)))


def distinct_ids(spark, d):
    return lookup_ids(c.raw_events(spark, d))


def age_at_date(spark, d):
    orders = c.table(spark, d, "orders")
    return orders.select(
        "o_orderkey", age_on(F.to_date("o_orderdate"), F.lit(date(2020, 2, 29))).alias("age")
    )


# --- enrichment -------------------------------------------------------------------------------


def enrich_students(spark, d):
    return enrich_events(c.raw_events(spark, d), **c.lookups(spark, d)).select(*RAW_COLUMNS, *STUDENT_COLUMNS)


def enrich_teachers(spark, d):
    return enrich_events(c.raw_events(spark, d), **c.lookups(spark, d)).select(*RAW_COLUMNS, *TEACHER_COLUMNS)


def enrich_full(spark, d):
    return enrich_events(c.raw_events(spark, d), **c.lookups(spark, d))


def missing_ids(spark, d):
    return missing_lookup_ids(c.raw_events(spark, d), *c.people(spark, d))


def requested_students(spark, d):
    """The student view, restricted to students the events refer to."""
    students, _ = c.people(spark, d)
    ids = lookup_ids(c.raw_events(spark, d)).filter(F.col("kind") == "student")
    return restrict_view(students, ids.select("id"))


def missing_sample(spark, d):
    """Ten ids at most of the people that the directory lacks, observed during one pass."""
    people = c.lookups(spark, d)
    rows = with_people(
        c.raw_events(spark, d), people["students"], people["teachers"], broadcast=people["broadcast"])
    rows, seen = observe_stage(
        rows, student=sampled_ids(F.col(STUDENT_KEY), ~F.col("student_found")),
        teacher=sampled_ids(F.col(TEACHER_KEY), ~F.col("teacher_found")),
    )
    rows.write.format("noop").mode("overwrite").save()
    found = [(kind, id) for kind in ("student", "teacher") for id in seen.get[kind]]
    return spark.createDataFrame(found, "kind string, id string")


def hit_counts(spark, d):
    return enrichment_hits(c.raw_events(spark, d), **c.lookups(spark, d))


def stage_counts(spark, d):
    """Counts of input, unique and enriched rows, taken during one pass."""
    rows, received = observe_stage(_doubled(c.raw_events(spark, d)))
    rows, unique = observe_stage(dedupe_events(rows))
    rows, written = observe_stage(
        enrich_events(rows, **c.lookups(spark, d)),
        with_student=F.count("STUDENT_FIO"), with_teacher=F.count("TEACHER_FIO"),
    )
    rows.write.format("noop").mode("overwrite").save()
    counts = [
        ("input", received.get["rows"]), ("unique", unique.get["rows"]),
        ("with_student", written.get["with_student"]), ("with_teacher", written.get["with_teacher"]),
        ("written", written.get["rows"]),
    ]
    return spark.createDataFrame(counts, "stage string, n_rows bigint")


# --- admission --------------------------------------------------------------------------------


def validate(spark, d):
    judged = admit.validate_marks(c.requests(spark, d), c.school(spark, d))
    return judged.select("request_id", "reject_reason")


def slot_check(spark, d):
    facts = admit.with_facts(c.requests(spark, d), c.school(spark, d))
    timed = admit.with_slot(facts.withColumn("NUMBER", F.col("lesson.NUMBER")))
    return timed.select("request_id", "NUMBER", "in_slot", admit.slot_reason().alias("slot_reason"))


def check_access(spark, d):
    return admit.check_access(c.requests(spark, d), c.school(spark, d)).select("request_id", "access_reason")


def derive_role(spark, d):
    return admit.check_access(c.requests(spark, d), c.school(spark, d)).select(
        "request_id", "marked_by_role", "marked_by"
    )


def existing_mark(spark, d):
    marks = c.valid_marks(c.raw_events(spark, d))
    return arbitrate.existing_marks(marks.select("ID", "DATE_CREATE", *MARK_KEY), marks)


def arbitrate_all(spark, d):
    settled = arbitrate.arbitrate_marks(c.valid_marks(c.raw_events(spark, d)))
    return settled.select("ID", "accepted", "reject_reason")


def arbitrate_on_history(spark, d):
    """Four fifths of the marks, where the other fifth was accepted 40 days before."""
    marks = c.valid_marks(c.raw_events(spark, d))
    is_old = F.col("ID").cast("bigint") % 5 == 0
    old = marks.filter(is_old).withColumn("DATE_CREATE", F.col("DATE_CREATE") - F.expr("INTERVAL 40 DAYS"))
    settled = arbitrate.arbitrate_marks(marks.filter(~is_old), old)
    return settled.select("ID", "accepted", "reject_reason")


def accepted_overwrites(spark, d):
    """Accepted marks that replaced another accepted mark."""
    settled = cut(arbitrate.arbitrate_marks(c.valid_marks(c.raw_events(spark, d))))
    accepted, _ = arbitrate.split_accepted(settled)
    return arbitrate.accepted_overwrites(accepted).select(*MARK_KEY, "ID", "prev_id")


def admission(spark, d):
    """Requests judged, made events and arbitrated."""
    settled = admit_and_settle(c.requests(spark, d), c.school(spark, d))
    return settled.select(
        *MARK_KEY, "ATTENDANCE_MARK", "MARKED_BY", "MARKED_BY_ROLE", "DATE_CREATE", "accepted", "reject_reason"
    )


# --- store ------------------------------------------------------------------------------------


def latest_marks(spark, d):
    return _mart(spark, d)


def latest_marks_window(spark, d):
    return latest.latest_marks_window(_enriched(spark, d))


def latest_non_null(spark, d):
    return latest.latest_non_null(_enriched(spark, d))


def merge_latest(spark, d):
    rows = c.valid_marks(c.raw_events(spark, d))
    odd = F.col("ID").cast("bigint") % 2 == 1
    merged = latest.merge_latest(latest.latest_rows(rows.filter(odd)), rows.filter(~odd))
    return latest.to_mart(enrich_events(merged, **c.lookups(spark, d)))


def _received(enriched: DataFrame) -> DataFrame:
    """Enriched events as the store receives them: sent as messages and read again."""
    return decode_enriched(to_messages(enriched))


def _store_input(spark: SparkSession, d: str) -> DataFrame:
    """Enriched events with UUID ids, and some values the store cannot hold."""
    n = F.col("ID").cast("bigint")
    return _received(
        _enriched(spark, d).withColumns(
            {
                "ID": F.when(n % 60 == 0, F.col("ID")).otherwise(stable_id(F.col("ID"))),
                "MARKED_BY": F.when(n % 40 == 0, -1).otherwise(F.col("MARKED_BY")),
                "NUMBER_CERT": F.when(n % 7 == 0, 300).otherwise((n % 200).cast("int")),
            }
        )
    )


def conform_rows(spark, d):
    rows, _ = conform_enriched(_store_input(spark, d))
    return rows


def conform_rejects(spark, d):
    _, rejects = conform_enriched(_store_input(spark, d))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def store_rejects(spark, d):
    """What the store refuses of received messages, as the store jobs keep it."""
    n = F.col("ID").cast("bigint")
    sent = to_messages(_enriched(spark, d).withColumns({
        "ID": F.when(n % 60 == 0, F.col("ID")).otherwise(stable_id(F.col("ID"))),
        "MARKED_BY": F.when(n % 40 == 0, -1).otherwise(F.col("MARKED_BY")),
    }))
    _, rejects = store_rows(sent)
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def history_by_month(spark, d):
    rows, _ = conform_enriched(_received(_enriched(spark, d)), uuid_ids=False)
    path = scratch_path(spark, "history")
    history_sink.append_history(rows, path)
    return history_sink.read_history(spark, path).groupBy("lesson_month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("STUDENT_ID").alias("students")
    )


def mart_upsert(spark, d):
    """The mart kept in a table: two batches, the second of them added twice, and a merge between."""
    rows, _ = conform_enriched(_received(_enriched(spark, d)), uuid_ids=False)
    landed, path = scratch_path(spark, "landed"), scratch_path(spark, "latest")
    rows.write.parquet(landed)
    odd = F.col("ID").cast("bigint") % 2
    for part in (1, 0, 0):
        latest_sink.upsert_latest(spark.read.schema(STORE).parquet(landed).filter(odd == part), path)
        if part:
            latest_sink.compact_latest(spark, path)
    return latest_sink.read_mart(spark, path)


def history_files(spark, d):
    """Merged months whose files do not overlap, of a history in three parts that repeat marks: rows,
    and pairs of neighbouring files where one begins before the other ends."""
    path = scratch_path(spark, "history")
    rows = cut(conform_enriched(_received(_enriched(spark, d)), uuid_ids=False)[0])
    number = F.col("ID").cast("bigint")
    for part in (number % 2 == 0, number % 3 != 0, number % 2 == 1):
        history_sink.append_history(rows.filter(part), path)
    history_sink.compact_history(spark, path, least=2)
    in_order = Window.partitionBy("lesson_month").orderBy("first", "last")
    files = history_sink.file_ranges(spark, path).withColumn("before", F.lag("last").over(in_order))
    return files.groupBy("lesson_month").agg(
        F.sum("n_rows").alias("n_rows"), F.count_if(F.col("before") > F.col("first")).alias("overlaps"))


def find_mark(spark, d):
    """The standing mark of one key: that of the smallest event."""
    path = scratch_path(spark, "history")
    rows, _ = conform_enriched(_received(_enriched(spark, d)), uuid_ids=False)
    history_sink.append_history(rows, path)
    history_sink.compact_history(spark, path)
    one = c.valid_marks(c.raw_events(spark, d)).orderBy(F.col("ID").cast("bigint")).first()
    return history_sink.find_mark(
        spark, path, journal_id=one["JOURNAL_ID"], student_id=one["STUDENT_ID"], lesson_id=one["LESSON_ID"],
        day=one["LESSON_DATE"],
    )


def message_rows(spark, d):
    messages = to_messages(_enriched(spark, d))
    return messages.select("key", F.inline(F.array(F.from_json("value", ENRICHED_EVENT))))


# --- reports ----------------------------------------------------------------------------------


def marks_by_group(spark, d):
    return reports.marks_by_group(_mart(spark, d), REPORT_GROUPS)


def student_attendance(spark, d):
    return reports.student_attendance(_mart(spark, d))


def marks_on_date(spark, d):
    return reports.marks_on_date(_mart(spark, d), REPORT_DAY)


def marks_by_teacher(spark, d):
    return reports.marks_by_teacher(_mart(spark, d))


def teacher_attendance_pct(spark, d):
    return reports.teacher_attendance_pct(_mart(spark, d))


def faculty_rollup(spark, d):
    return reports.faculty_rollup(_mart(spark, d))


# --- streaming --------------------------------------------------------------------------------


def _message_stream(spark: SparkSession, d: str) -> DataFrame:
    return c.to_messages(c.to_raw_events(c.event_stream(spark, d)))


# Messages of a file, which is what one task decodes.
_ROWS_A_FILE = 100_000


def _written_stream(spark: SparkSession, d: str) -> DataFrame:
    """Enriched messages written to files in three parts, as a stream of those files. A part has as many
    files as its rows ask for, so no part is left to one task."""
    path = scratch_path(spark, "enriched")
    files = max(1, -(-c.table(spark, d, "events").count() // (3 * _ROWS_A_FILE)))
    enriched = enrich_events(c.valid_marks(c.spread(c.raw_events(spark, d))), **c.lookups(spark, d))
    write_messages(to_messages(enriched).repartition(3 * files, "key"), "parquet", path=path)
    return read_messages(spark, "parquet", stream=True, path=path, maxFilesPerTrigger=str(files))


def stream_enrich(spark, d):
    out = scratch_path(spark, "stream-enriched")
    query = start_enrichment(
        _message_stream(spark, d),
        DirectorySnapshot(lambda s: _documents(s, d), today=lambda: c.AS_OF),
        lambda rows, batch_id: write_messages(rows, "parquet", batch_id=batch_id, path=out),
        scratch_path(spark, "stream-enrich-checkpoint"),
    )
    query.awaitTermination()
    return decode_enriched(spark.read.schema(MESSAGE).parquet(out)).select(*OUTPUT_COLUMNS)


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return c.parse_documents(c.directory_documents(spark, d))


def stream_rejects(spark, d):
    """Messages that cannot be decoded, kept by a job of their own."""
    out = scratch_path(spark, "stream-rejects")
    start_rejects(
        _message_stream(spark, d), lambda rows, batch_id: write_messages(rows, "parquet", batch_id=batch_id, path=out),
        scratch_path(spark, "stream-rejects-checkpoint"),
    ).awaitTermination()
    return spark.read.schema("key string, reason string").parquet(out).select("key", "reason")


def stream_dedupe(spark, d):
    out = scratch_path(spark, "stream-unique")
    raw = c.to_raw_events(c.event_stream(spark, d))
    copies = c.to_raw_events(c.event_stream(spark, d)).filter(F.col("ID").cast("bigint") % 3 == 0)
    unique = dedupe_stream(raw.unionByName(copies))
    query = start_batches(
        unique.select("ID", "STUDENT_ID", "DATE_CREATE"),
        lambda rows, batch_id: write_messages(rows, "parquet", batch_id=batch_id, path=out),
        scratch_path(spark, "stream-dedupe-checkpoint"),
    )
    query.awaitTermination()
    return spark.read.schema("ID string, STUDENT_ID int, DATE_CREATE timestamp_ntz").parquet(out).drop("batch_id")


def stream_dedupe_watermark(spark, d):
    """Events in three files by time, with a watermark of two days. The third repeats the last day of the
    second, which is remembered, and all of the first ten days, which is too late."""
    path, out = scratch_path(spark, "watermark-input"), scratch_path(spark, "stream-within")
    raw = c.raw_events(spark, d)
    day = F.day("LESSON_DATE")
    for part in (day <= 15, day.between(16, 20), (day > 20) | (day <= 10) | (day == 20)):
        raw.filter(part).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(path)
    start_batches(
        dedupe_stream(stream, watermark="2 days").select("ID", "STUDENT_ID", "DATE_CREATE"),
        lambda rows, batch_id: write_messages(rows, "parquet", batch_id=batch_id, path=out),
        scratch_path(spark, "stream-within-checkpoint"),
    ).awaitTermination()
    kept = spark.read.schema("ID string, STUDENT_ID int, DATE_CREATE timestamp_ntz").parquet(out).drop("batch_id")
    return kept


def stream_latest_non_null(spark, d):
    path, checkpoint = scratch_path(spark, "stream-non-null"), scratch_path(spark, "stream-non-null-checkpoint")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        rows, _ = store_rows(batch, uuid_ids=False)
        latest_sink.upsert_non_null(rows, path, query_id(spark, checkpoint), batch_id)
        if batch_id == 1:
            latest_sink.compact_non_null(spark, path)

    start_batches(_written_stream(spark, d), on_batch, checkpoint).awaitTermination()
    return latest_sink.read_non_null(spark, path)


def stream_reports(spark, d):
    """All reports, kept up to date over three batches, in one table."""
    state, figures = scratch_path(spark, "figures-state"), scratch_path(spark, "figures")
    start_figures(
        _written_stream(spark, d), state, figures, scratch_path(spark, "figures-checkpoint"), uuid_ids=False,
        merge_every=2,
    ).awaitTermination()

    def report(name: str, keys: list[str], values: list[str], **options) -> DataFrame:
        found = read_report(spark, figures, name, **options)
        texts = [F.col(k).cast("string") for k in keys] + [F.lit(None).cast("string")] * (3 - len(keys))
        numbers = [F.col(v).cast("double") for v in values] + [F.lit(None).cast("double")] * (3 - len(values))
        return found.select(
            F.lit(name).alias("report"), *[x.alias(f"key_{i}") for i, x in enumerate(texts, 1)],
            *[x.alias(f"value_{i}") for i, x in enumerate(numbers, 1)])

    parts = [
        report("marks_by_group", ["group_short_title", "attendance_mark"], ["marks"], groups=REPORT_GROUPS),
        report("student_attendance", ["STUDENT_ID", "student_fio", "group_short_title"], ["present", "absent"]),
        report("marks_on_date", [], ["marks"], as_of=REPORT_DAY),
        report("marks_by_teacher", ["marked_by", "teacher_fio", "attendance_mark"], ["marks"]),
        report("teacher_attendance_pct", ["marked_by", "teacher_fio", "kafedra"], ["marks", "present_pct", "absent_pct"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def stream_marks_per_day(spark, d):
    path = scratch_path(spark, "daily")
    start_daily_marks(
        c.valid_marks(c.to_raw_events(c.event_stream(spark, d))), path, scratch_path(spark, "daily-checkpoint"),
    ).awaitTermination()
    return read_daily_marks(spark, path)


def stream_latest(spark, d):
    path = scratch_path(spark, "stream-latest")
    start_mart(
        _written_stream(spark, d), path, scratch_path(spark, "stream-latest-checkpoint"), uuid_ids=False
    ).awaitTermination()
    return latest_sink.read_mart(spark, path)


def stream_history(spark, d):
    path = scratch_path(spark, "stream-history")
    start_history(
        _written_stream(spark, d), path, scratch_path(spark, "stream-history-checkpoint"), uuid_ids=False
    ).awaitTermination()
    return history_sink.read_history(spark, path)


def _settled_stream(spark: SparkSession, requests: DataFrame, **options) -> DataFrame:
    out, checkpoint = scratch_path(spark, "stream-settled"), scratch_path(spark, "stream-settle-checkpoint")

    def sink(accepted: DataFrame, rejected: DataFrame, batch_id: int) -> None:
        both = accepted.select("ID", F.lit(None).cast("string").alias("reject_reason")).unionByName(
            rejected.select("ID", "reject_reason")
        )
        write_messages(both, "parquet", batch_id=batch_id, path=out)

    start_settlement(requests, scratch_path(spark, "standing"), sink, checkpoint, **options).awaitTermination()
    settled = spark.read.schema("ID string, reject_reason string").parquet(out)
    return settled.select("ID", F.col("reject_reason").isNull().alias("accepted"), "reject_reason")


def stream_admission(spark, d):
    """Request messages judged by a copy of the journal's tables, made events and settled."""
    out, refused = scratch_path(spark, "stream-admitted"), scratch_path(spark, "stream-refused")
    messages = c.request_messages(c.to_requests(c.to_raw_events(c.event_stream(spark, d))))
    requests, _ = decode_requests(messages)

    def sink(accepted: DataFrame, rejected: DataFrame, batch_id: int) -> None:
        both = accepted.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejected)
        both.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    start_admission(
        requests, SchoolSnapshots(lambda s: c.school(s, d), scratch_path(spark, "school")),
        scratch_path(spark, "standing"), sink, scratch_path(spark, "stream-admit-checkpoint"),
        refuse=lambda rows, batch_id: rows.write.mode("overwrite").parquet(f"{refused}/batch_id={batch_id}"),
    ).awaitTermination()
    settled = spark.read.parquet(out)
    return settled.select(
        "JOURNAL_ID", "STUDENT_ID", "LESSON_ID", F.date_format("LESSON_DATE", "yyyy-MM-dd").alias("LESSON_DATE"),
        "ATTENDANCE_MARK", "MARKED_BY", "MARKED_BY_ROLE", "DATE_CREATE",
        F.col("reject_reason").isNull().alias("accepted"), "reject_reason",
    )


def stream_arbitrate(spark, d):
    """Requests settled as they arrive, the events file being one batch."""
    return _settled_stream(spark, c.valid_marks(c.to_raw_events(c.event_stream(spark, d))))


def stream_settle(spark, d):
    """The same job by its other name, kept for those who call it."""
    return stream_arbitrate(spark, d)


def stream_settle_batches(spark, d):
    """The requests in three batches by time, each meeting what the batches before it left, with the
    standing marks merged in between."""
    path = scratch_path(spark, "settle-input")
    marks = c.valid_marks(c.raw_events(spark, d))
    parts = [F.day("LESSON_DATE") <= 10, F.day("LESSON_DATE").between(11, 20), F.day("LESSON_DATE") > 20]
    for part in parts:
        marks.filter(part).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(marks.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return _settled_stream(spark, stream, merge_every=2)


QUERIES: dict[str, Query] = {
    "group_marks": group_marks,
    "decode_props": decode_props,
    "decode_rejects": decode_rejects,
    "duplicate_report": duplicates,
    "dedupe_events": deduped,
    "distinct_lookup_ids": distinct_ids,
    "flatten_students": lambda s, d: c.people(s, d)[0],
    "flatten_teachers": lambda s, d: c.people(s, d)[1],
    "age_at_date": age_at_date,
    "enrich_students": enrich_students,
    "enrich_teachers": enrich_teachers,
    "enrich_full": enrich_full,
    "requested_students": requested_students,
    "missing_lookup_ids": missing_ids,
    "enrichment_hit_counts": hit_counts,
    "stage_counts": stage_counts,
    "validate_marks": validate,
    "slot_check": slot_check,
    "check_access": check_access,
    "derive_role": derive_role,
    "existing_mark": existing_mark,
    "arbitrate_marks": arbitrate_all,
    "arbitrate_on_history": arbitrate_on_history,
    "accepted_overwrites": accepted_overwrites,
    "mark_admission": admission,
    "latest_marks": latest_marks,
    "latest_marks_window": latest_marks_window,
    "latest_non_null": latest_non_null,
    "merge_latest": merge_latest,
    "conform_enriched": conform_rows,
    "conform_rejects": conform_rejects,
    "store_rejects": store_rejects,
    "history_by_month": history_by_month,
    "mart_upsert": mart_upsert,
    "kafka_rows": message_rows,
    "marks_by_group": marks_by_group,
    "student_attendance": student_attendance,
    "marks_on_date": marks_on_date,
    "marks_by_teacher": marks_by_teacher,
    "teacher_attendance_pct": teacher_attendance_pct,
    "stream_enrich": stream_enrich,
    "stream_rejects": stream_rejects,
    "stream_dedupe": stream_dedupe,
    "stream_latest": stream_latest,
    "stream_history": stream_history,
    "stream_arbitrate": stream_arbitrate,
    "stream_settle": stream_settle,
    "stream_settle_batches": stream_settle_batches,
    "stream_dedupe_watermark": stream_dedupe_watermark,
    "stream_latest_non_null": stream_latest_non_null,
    "stream_reports": stream_reports,
    "stream_marks_per_day": stream_marks_per_day,
    "history_files": history_files,
    "find_mark": find_mark,
    "faculty_rollup": faculty_rollup,
    "missing_sample": missing_sample,
    "stream_admission": stream_admission,
}

"""Raw messages to enriched messages, continuously."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollmark.operators.enrich import STUDENT_KEY, TEACHER_KEY, with_people
from rollmark.operators.metrics import observe_stage, sampled_ids
from rollmark.schemas import OUTPUT_COLUMNS
from rollmark.sinks.messages import to_messages
from rollmark.sources.messages import decode_events
from rollmark.streaming.late import LateRows
from rollmark.streaming.run import start_batches
from rollmark.streaming.snapshot import DirectorySnapshot

Sink = Callable[[DataFrame, int], None]
_TIME = "_event_time"
# How far a producer's clock may be ahead.
AHEAD = "1 DAY"


def usable_time() -> Column:
    """Is DATE_CREATE a time that a watermark may follow? One that cannot be read, or lies in the
    future, would let copies through or make all later events late."""
    seen_at = F.col("DATE_CREATE").try_cast("timestamp")
    return F.coalesce(seen_at <= F.current_timestamp() + F.expr(f"INTERVAL {AHEAD}"), F.lit(False))


def dedupe_stream(events: DataFrame, *, watermark: str | None = None) -> DataFrame:
    """Drop events whose ID was seen before.

    Without a watermark every ID is remembered for good. With one (such as '2 days', measured on
    DATE_CREATE) IDs are forgotten and late rows dropped, and rows without a usable time are left
    out (``start_rejects`` keeps them).
    """
    if watermark is not None:
        seen_at = F.col("DATE_CREATE").try_cast("timestamp")
        events = events.filter(usable_time()).withColumn(_TIME, seen_at).withWatermark(_TIME, watermark)

    def drop(rows: DataFrame, key: list[str]) -> DataFrame:
        return rows.dropDuplicates(key) if watermark is None else rows.dropDuplicatesWithinWatermark(key)

    return drop(events, ["ID"]).drop(_TIME)


def start_enrichment(
    messages: DataFrame,
    directory: DirectorySnapshot,
    sink: Sink,
    checkpoint: str,
    *,
    watermark: str | None = None,
    every: str | None = None,
    on_metrics: Callable[[int, dict], None] | None = None,
) -> StreamingQuery:
    """Decode, dedupe and enrich messages; ``sink(messages, batch_id)`` writes the result.

    Each batch is one plan with one action, the write; the counts given to ``on_metrics`` are
    taken while the rows pass, and so are up to ten ids each of the students and teachers that the
    directory lacks. With a watermark it also gets, once a batch is done, how many of its
    rows came too late and were dropped, as ``late``.
    """
    events, _ = decode_events(messages)
    events = dedupe_stream(events, watermark=watermark)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        people = directory.current(batch.sparkSession)
        rows = with_people(batch, people.students, people.teachers, broadcast=people.broadcast)
        rows, seen = observe_stage(
            rows,
            student_found=F.count_if("student_found"),
            student_missing=F.count_if(F.col(STUDENT_KEY).isNotNull() & ~F.col("student_found")),
            teacher_found=F.count_if("teacher_found"),
            teacher_missing=F.count_if(F.col(TEACHER_KEY).isNotNull() & ~F.col("teacher_found")),
            missing_students=sampled_ids(F.col(STUDENT_KEY), ~F.col("student_found")),
            missing_teachers=sampled_ids(F.col(TEACHER_KEY), ~F.col("teacher_found")),
        )
        sink(to_messages(rows.select(*OUTPUT_COLUMNS)), batch_id)
        if on_metrics is not None:
            on_metrics(batch_id, seen.get)

    name = None
    if watermark is not None and on_metrics is not None:
        name = f"enrich-{uuid.uuid4().hex}"
        messages.sparkSession.streams.addListener(LateRows(name, on_metrics))
    return start_batches(events, on_batch, checkpoint, every=every, name=name)


def start_rejects(
    messages: DataFrame, sink: Sink, checkpoint: str, *, watermark: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Write the messages without a usable ID, with their reason; where a watermark is used, the
    events without a usable time, too (key, reason ``bad_time``)."""
    events, rejects = decode_events(messages)
    if watermark is not None:
        untimed = events.filter(~usable_time()).select(F.col("ID").alias("key"), F.lit("bad_time").alias("reason"))
        rejects = rejects.select("key", "reason").unionByName(untimed)
    return start_batches(rejects, sink, checkpoint, every=every)

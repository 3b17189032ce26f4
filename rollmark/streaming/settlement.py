"""Arbitration of marks batch by batch, with the standing marks in a table.

The batch operator does the work, so a key with very many requests is split over tasks and no
Python runs. A batch adds the marks it accepted to the table of standing marks and rewrites nothing
there; of a key the mark of the last batch stands. A batch that runs again starts from what the other
batches left, which is what it started from the first time, and gives the same answers.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollmark.operators.arbitrate import accepted_overwrites, arbitrate_marks, split_accepted
from rollmark.plans.skew import ROWS_PER_TASK
from rollmark.schemas import MARK_KEY
from rollmark.sinks.deltas import NUMBER, DeltaTable
from rollmark.streaming.run import query_id, start_batches

DAY = "LESSON_DATE"
MARK = ["DATE_CREATE", "ID", "MARKED_BY", "MARKED_BY_ROLE", "ATTENDANCE_MARK"]
# Lesson days that a request may name: they become partitions.
DAYS = (date(2000, 1, 1), date(2099, 12, 31))
# Batches after which a day's standing marks are merged.
MERGE_EVERY = 16

Sink = Callable[[DataFrame, DataFrame, int], None]


def _last_by_batch(rows: DataFrame) -> DataFrame:
    """The mark of each key that was accepted last: of the last batch, and of the latest time in it."""
    last = rows.groupBy(*MARK_KEY).agg(F.max(F.struct(NUMBER, *MARK)).alias("mark"))
    return last.select(*MARK_KEY, "mark.*")


def standing_marks(path: str, kinds: dict[str, str]) -> DeltaTable:
    """The table of standing marks; ``kinds`` are the types of the requests' columns."""
    columns = ", ".join(f"{c} {kinds[c]}" for c in [*MARK_KEY, *MARK])
    return DeltaTable(path, columns, DAY, tuple(MARK_KEY), _last_by_batch, tuple(MARK_KEY))


def settle_batch(
    requests: DataFrame, path: str, batch_id: int, sink: Sink, *, rows_per_task: int = ROWS_PER_TASK,
    run: str = "once", overwrites: Callable[[DataFrame, int], None] | None = None,
    days: tuple[date, date] = DAYS, merge_every: int = MERGE_EVERY,
) -> None:
    """Settle the requests of one batch, hand (accepted, rejected, batch_id) to the sink, and add
    what was accepted to the standing marks. The sink may see a batch twice. Requests that lack a part
    of the key are rejected as ``no_key``, those for a day outside ``days`` as ``bad_day``; LESSON_DATE
    must be a date. ``overwrites`` gets (rows, batch_id): the accepted marks that replaced another."""
    spark = requests.sparkSession
    if dict(requests.dtypes)[DAY] != "date":
        raise TypeError(f"{DAY} must be a date")
    table = standing_marks(path, dict(requests.dtypes))
    requests = requests.persist(StorageLevel.MEMORY_AND_DISK)
    settled = None
    try:
        whole = F.lit(True)
        for k in MARK_KEY:
            whole = whole & F.col(k).isNotNull()
        fault = F.when(~whole, "no_key").when(~F.col(DAY).between(*(F.lit(d) for d in days)), "bad_day")
        unusable, arrived = requests.filter(fault.isNotNull()), requests.filter(fault.isNull())
        # At most as many as there are days in the range.
        named = {str(r[DAY]) for r in arrived.select(DAY).distinct().collect()}
        standing = table.read(spark, named.__contains__, but=(run, batch_id))
        seeds = standing.join(arrived.select(*MARK_KEY).distinct(), MARK_KEY, "left_semi").withColumn(
            "TYPE_MARK", F.lit(0))
        settled = arbitrate_marks(arrived, seeds, rows_per_task=rows_per_task).persist(
            StorageLevel.MEMORY_AND_DISK
        )
        accepted, rejected = split_accepted(settled)
        rejected = rejected.unionByName(unusable.withColumn("reject_reason", fault), allowMissingColumns=True)
        sink(accepted, rejected, batch_id)
        if overwrites is not None:
            overwrites(accepted_overwrites(accepted, seeds, rows_per_task=rows_per_task), batch_id)
        newest = accepted.groupBy(*MARK_KEY).agg(F.max(F.struct(*MARK)).alias("mark"))
        table.add(newest.select(*MARK_KEY, "mark.*"), run, batch_id)
        if batch_id % merge_every == merge_every - 1:
            table.merge(spark)
    finally:
        requests.unpersist()
        if settled is not None:
            settled.unpersist()


def start_settlement(
    requests: DataFrame,
    path: str,
    sink: Sink,
    checkpoint: str,
    *,
    every: str | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    overwrites: Callable[[DataFrame, int], None] | None = None,
    merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Settle streaming requests. Within a batch they are taken in order of
    (DATE_CREATE, ID); across batches the order of arrival counts."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        run = query_id(batch.sparkSession, checkpoint)
        settle_batch(
            batch, path, batch_id, sink, rows_per_task=rows_per_task, run=run, overwrites=overwrites,
            merge_every=merge_every,
        )

    return start_batches(requests, on_batch, checkpoint, every=every)

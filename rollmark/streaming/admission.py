"""Mark requests to accepted events, continuously.

Requests are judged by the journal's tables, which change. Each batch is tied to one copy of them, and the
tie is kept in the shared folder, so a batch that runs again, also after a restart, judges as it did.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollmark.operators.admit import School, lookup_sizes, to_events, validate_marks
from rollmark.plans.skew import ROWS_PER_TASK
from rollmark.sinks.files import exists, file_system
from rollmark.sources.school import TABLES, read_school
from rollmark.streaming.run import query_id, start_batches
from rollmark.streaming.settlement import MERGE_EVERY, Sink, settle_batch

Refuse = Callable[[DataFrame, int], None]


class SchoolSnapshots:
    """Copies of the journal's tables below ``root``, made by the first batch after ``refresh_seconds``.

    ``load`` reads the tables; if it fails the batch fails and is run again later. Copies that neither of
    a run's last two batches is tied to are deleted.
    """

    def __init__(
        self, load: Callable[[SparkSession], School], root: str, refresh_seconds: float = 600, *,
        clock: Callable[[], float] = time.monotonic,
    ):
        self._load, self._root, self._refresh, self._clock = load, root.rstrip("/"), refresh_seconds, clock
        self._name: str | None = None
        self._made_at = 0.0
        self._broadcast: dict[str, list[bool]] = {}

    def of_batch(self, spark: SparkSession, run: str, batch: int) -> tuple[School, list[bool]]:
        """The tables that this batch is judged by, and which of their lookups may be broadcast."""
        ties = self._ties(spark, run)
        name = ties.get(batch)
        if name is None:
            name = self._current(spark)
            fs, tie = file_system(spark, f"{self._root}/ties/{run}_{batch}_{name}")
            fs.create(tie, True).close()
            self._forget(spark, run, {b: n for b, n in ties.items() if b < batch - 1})
        school = read_school(spark, f"{self._root}/{name}")
        if name not in self._broadcast:
            self._broadcast = {name: lookup_sizes(school)}
        return school, self._broadcast[name]

    def _current(self, spark: SparkSession) -> str:
        if self._name is None or self._clock() - self._made_at > self._refresh:
            now, name = self._clock(), f"school-{uuid.uuid4().hex}"
            school = self._load(spark)
            for table, ddl in TABLES.items():
                columns = [field.split() for field in ddl.split(", ")]
                there = getattr(school, table)
                wanted = [
                    F.col(c).cast(kind).alias(c) if c in there.columns else F.lit(None).cast(kind).alias(c)
                    for c, kind in columns
                ]
                there.select(*wanted).write.parquet(f"{self._root}/{name}/{table}")
            self._name, self._made_at = name, now
        return self._name

    def _ties(self, spark: SparkSession, run: str) -> dict[int, str]:
        out = {}
        for name in self._listed(spark):
            tied, batch, snapshot = name.split("_")
            if tied == run:
                out[int(batch)] = snapshot
        return out

    def _listed(self, spark: SparkSession) -> list[str]:
        fs, ties = file_system(spark, f"{self._root}/ties")
        return [s.getPath().getName() for s in fs.listStatus(ties)] if fs.exists(ties) else []

    def _forget(self, spark: SparkSession, run: str, old: dict[int, str]) -> None:
        for batch, name in old.items():
            fs, tie = file_system(spark, f"{self._root}/ties/{run}_{batch}_{name}")
            fs.delete(tie, False)
        used = {name.split("_")[2] for name in self._listed(spark)} | {self._name}
        for name in set(old.values()) - used:
            if exists(spark, f"{self._root}/{name}"):
                fs, copy = file_system(spark, f"{self._root}/{name}")
                fs.delete(copy, True)


def start_admission(
    requests: DataFrame, school: SchoolSnapshots, standing: str, sink: Sink, checkpoint: str, *,
    refuse: Refuse | None = None, every: str | None = None, rows_per_task: int = ROWS_PER_TASK,
    overwrites: Callable[[DataFrame, int], None] | None = None, merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Judge streaming requests, make events of those that pass, and settle these against the standing
    marks below ``standing``. ``sink`` gets (accepted, rejected, batch_id) of the events, ``refuse`` the
    requests that did not pass, as (request_id, reject_reason)."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = query_id(spark, checkpoint)
        tables, small = school.of_batch(spark, run, batch_id)
        judged = validate_marks(batch, tables, broadcast=small, rows_per_task=rows_per_task).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            if refuse is not None:
                refuse(judged.filter(F.col("reject_reason").isNotNull()).select("request_id", "reject_reason"), batch_id)
            events = to_events(judged).withColumn("LESSON_DATE", F.col("LESSON_DATE").cast("date"))
            settle_batch(
                events, standing, batch_id, sink, rows_per_task=rows_per_task, run=run, overwrites=overwrites,
                merge_every=merge_every,
            )
        finally:
            judged.unpersist()

    return start_batches(requests, on_batch, checkpoint, every=every)

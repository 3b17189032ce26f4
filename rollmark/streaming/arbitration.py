"""Arbitration of marks as they arrive, with the standing mark of each key as state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StringType, StructType

from rollmark.functions.lessons import DEAN, MONITOR, STUDENT, TEACHER
from rollmark.schemas import MARK_KEY

STATE = "by bigint, role int, mark int"


def verdict(stands: tuple | None, by, role, mark) -> str | None:
    """Reason to reject a request given the standing (by, role, mark), or None to accept it."""
    if role not in (STUDENT, MONITOR, TEACHER, DEAN):
        return "unknown_role"
    if stands is None:
        return None
    own, same = stands[0] == by, stands[0] == by and stands[2] == mark
    if role in (TEACHER, DEAN):
        return "same_value" if same else None
    if stands[1] in (TEACHER, DEAN):
        return "teacher_mark"
    if role == STUDENT and not own:
        return "monitor_mark" if stands[1] == MONITOR else "other_user"
    return "same_value" if same else None


def _by_arrival(row: Row) -> tuple:
    """Order of (DATE_CREATE, ID), NULL first as in the batch form."""
    return (row.DATE_CREATE is not None, row.DATE_CREATE), (row.ID is not None, row.ID)


class MarkArbiter(StatefulProcessor):
    """One value per key: who set the standing mark, in which role, and the mark."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._stands = handle.getValueState("stands", STATE)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        row = initialState
        self._stands.update((row.MARKED_BY, row.MARKED_BY_ROLE, row.ATTENDANCE_MARK))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = stands = self._stands.get()
        for row in sorted(rows, key=_by_arrival):
            request = (row.MARKED_BY, row.MARKED_BY_ROLE, row.ATTENDANCE_MARK)
            reason = verdict(stands, *request)
            if reason is None:
                stands = request
            yield Row(**row.asDict(), accepted=reason is None, reject_reason=reason)
        if stands != before:
            self._stands.update(stands)

    def close(self) -> None:
        pass


def arbitrate_stream(requests: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Streaming requests with ``accepted`` and ``reject_reason``.

    Rows of one micro-batch are taken in order of (DATE_CREATE, ID); across batches the order of
    arrival counts. Limit the size of a micro-batch at the source (``maxOffsetsPerTrigger``,
    ``maxFilesPerTrigger``): that also limits the rows of one key a task holds. ``history`` are
    the latest accepted marks to start from, one row per key, such as ``read_state`` gives. The
    session must keep streaming state in RocksDB (``use_rocksdb``).
    """
    out = StructType([*requests.schema.fields]).add("accepted", BooleanType()).add("reject_reason", StringType())
    return requests.groupBy(*MARK_KEY).transformWithState(
        statefulProcessor=MarkArbiter(),
        outputStructType=out,
        outputMode="append",
        timeMode="none",
        initialState=None if history is None else history.groupBy(*MARK_KEY),
    )

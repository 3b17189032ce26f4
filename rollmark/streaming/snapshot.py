"""The user directory as streaming batches see it."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from rollmark.operators.directory import flatten_directory, student_view, teacher_view
from rollmark.plans.sizing import fits_broadcast


@dataclass(frozen=True)
class People:
    students: DataFrame
    teachers: DataFrame
    broadcast: tuple[bool, bool]


class DirectorySnapshot:
    """Both directory views, read anew by the first batch after ``refresh_seconds``.

    ``load`` returns the documents. If it fails, the batch fails and is run again later, rather
    than going on without attributes. The views are measured once per refresh.
    """

    def __init__(
        self,
        load: Callable[[SparkSession], DataFrame],
        refresh_seconds: float = 3600,
        *,
        today: Callable[[], date] = date.today,
        clock: Callable[[], float] = time.monotonic,
    ):
        self._load, self._refresh, self._today, self._clock = load, refresh_seconds, today, clock
        self._people: People | None = None
        self._read_at = 0.0

    def current(self, spark: SparkSession) -> People:
        if self._people is None or self._clock() - self._read_at > self._refresh:
            old, now = self._people, self._clock()
            flat = flatten_directory(self._load(spark), self._today())
            views = [v(flat).persist(StorageLevel.MEMORY_AND_DISK) for v in (student_view, teacher_view)]
            self._people = People(*views, broadcast=tuple(fits_broadcast(*views)))
            self._read_at = now
            if old is not None:
                old.students.unpersist()
                old.teachers.unpersist()
        return self._people

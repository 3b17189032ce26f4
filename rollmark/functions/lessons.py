"""Lesson slots and the roles and marks of the journal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- fixed values ---------------------------------------------------------------------------

# Slot number, start, end.
SLOTS = [
    (1, "09:00", "10:30"),
    (2, "10:45", "12:15"),
    (3, "12:30", "14:00"),
    (4, "15:00", "16:30"),
    (5, "16:45", "18:15"),
    (6, "18:30", "20:00"),
    (7, "20:15", "21:45"),
    (8, "22:00", "23:30"),
]

MARKS = [0, 1, 2, 3]
DEAN_MARKS = [2, 3]

STUDENT, MONITOR, TEACHER, DEAN = 0, 1, 2, 3

# --- end of fixed values --------------------------------------------------------------------


def slot_table(spark: SparkSession) -> DataFrame:
    """The eight slots as (NUMBER, slot_start, slot_end), times as HH:mm:ss text."""
    rows = ", ".join(f"({n}, '{start}:00', '{end}:00')" for n, start, end in SLOTS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS slots(NUMBER, slot_start, slot_end)")

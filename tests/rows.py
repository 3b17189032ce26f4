"""Row makers shared by the tests."""

from datetime import date, datetime, timedelta
import random

from rollmark.schemas import OUTPUT_COLUMNS, RAW_EVENT

EVENT = RAW_EVENT.replace("DATE_CREATE string", "DATE_CREATE timestamp_ntz").replace(
    "LESSON_DATE string", "LESSON_DATE date"
)
NAMES = [f.split()[0] for f in EVENT.split(",")]
START = datetime(2024, 3, 4, 9, 0)


def event(id, *, at=0, mark=1, by=7, role=2, journal=1, student=5, lesson=10, day=date(2024, 3, 4), type_mark=0):
    return dict(
        ID=str(id), JOURNAL_ID=journal, STUDENT_ID=student, LESSON_DATE=day, ATTENDANCE_MARK=mark,
        MARKED_BY=by, DATE_CREATE=START + timedelta(seconds=at), LESSON_ID=lesson, TYPE_MARK=type_mark,
        NUMBER_CERT=None, MARKED_BY_ROLE=role,
    )


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], EVENT)


def random_events(seed, n, *, keys=4, markers=3, ties=True):
    rng = random.Random(seed)
    return [
        event(
            f"{rng.randrange(10**6)}-{i}", at=rng.randrange(n if ties else 10**9), mark=rng.randrange(3),
            by=rng.randrange(markers), role=rng.choice([0, 0, 0, 1, 1, 2, 3, None, 9][: rng.choice([3, 5, 7, 9])]),
            student=rng.randrange(keys),
        )
        for i in range(n)
    ]


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


def message(**fields):
    import json

    return json.dumps(fields)


def enriched(spark, rows):
    """Events with empty people columns."""
    from pyspark.sql import functions as F

    df = frame(spark, rows)
    ints = {"STUDENT_AGE", "ADMISSION_YEAR", "COURSE", "TEACHER_AGE"}
    return df.select(
        *[
            F.col(c) if c in NAMES else F.lit(None).cast("int" if c in ints else "string").alias(c)
            for c in OUTPUT_COLUMNS
        ]
    )

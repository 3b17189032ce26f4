from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rollmark.functions import scalars as s
from rollmark.functions.lessons import slot_table


def one(spark, expr, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(expr.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "birth, day, age",
    [
        (date(2000, 5, 5), date(2020, 5, 5), 20),
        (date(2000, 5, 6), date(2020, 5, 5), 19),
        (date(2000, 2, 29), date(2001, 2, 28), 0),
        (date(2000, 2, 29), date(2001, 3, 1), 1),
        (date(2030, 1, 2), date(2020, 1, 1), -11),
    ],
)
def test_age(spark, birth, day, age):
    assert one(spark, s.age_on(F.col("b"), F.col("d")), b=birth, d=day) == age


def test_age_without_birth_date(spark):
    assert one(spark, s.age_on(F.lit(None).cast("date"), F.lit(date(2020, 1, 1)))) == 0


@pytest.mark.parametrize(
    "text, day",
    [
        ("2001-02-03T04:05:06Z", date(2001, 2, 3)), ("2001-2-3T0:0:0Z", date(2001, 2, 3)),
        ("2001-02-03", None), ("2001-02-30T00:00:00Z", None), ("", None), ("n/a", None),
    ],
)
def test_instant_date(spark, text, day):
    assert one(spark, s.instant_date(F.col("t")), t=text) == day


@pytest.mark.parametrize(
    "text, number", [("2019", 2019), ("", 0), ("20x", 0), ("-5", 0), (" 7", 0), ("99999999999", 0), ("7\n", 0)]
)
def test_digits_or_zero(spark, text, number):
    assert one(spark, s.digits_or_zero(F.col("t")), t=text) == number


@pytest.mark.parametrize(
    "text, number",
    [("7", 7), (" 7 ", 7), ("7.9", 7), ("-2", -2), ("1e3", 1000), ("9007199254740993", 9007199254740993),
     ("x", None), ("", None), ("0x1A", None), ("1d", None), ("NaN", None)],
)
def test_whole_number(spark, text, number):
    assert one(spark, s.whole_number(F.col("t")), t=text) == number


def test_micros_text(spark):
    ts = lambda text: F.lit(text).cast("timestamp_ntz")
    assert one(spark, s.micros_text(ts("2024-01-02 03:04:05.5"))) == "2024-01-02 03:04:05.500000"
    assert one(spark, s.micros_text(ts("2024-01-02 03:04:05"))) == "2024-01-02 03:04:05.000000"


def test_stable_id(spark):
    make = lambda *v: one(spark, s.stable_id(*[F.lit(x) for x in v]))
    assert make("a", 1) == make("a", 1) != make("a", 2)
    assert make("a", None) != make(None, "a")
    import re

    assert re.fullmatch(s.UUID_PATTERN.replace(r"\A", "").replace(r"\z", ""), make("a", 1))


def test_range_and_month(spark):
    assert one(spark, s.in_range(F.col("x"), "int", 0, 255), x=256) is None
    assert one(spark, s.in_range(F.col("x"), "int", 0, 255), x=255) == 255
    assert one(spark, s.lesson_month(F.col("x")), x=date(2024, 3, 9)) == "202403"


def test_slots(spark):
    rows = slot_table(spark).collect()
    assert [r.NUMBER for r in sorted(rows)] == list(range(1, 9))
    assert all(len(r.slot_start) == 8 and r.slot_start < r.slot_end for r in rows)
    assert one(spark, s.time_of_day(F.col("x")), x=datetime(2024, 1, 2, 3, 4, 5)) == "03:04:05"

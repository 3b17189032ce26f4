"""Scalar expressions used by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UUID_PATTERN = r"\A[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\z"
NUMBER_PATTERN = r"\A\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"


def instant_date(text: Column) -> Column:
    """Date of an ISO instant such as 2001-02-03T00:00:00Z; NULL for any other text."""
    return F.try_to_timestamp(text, F.lit("yyyy-M-d'T'H:m:s'Z'")).cast("date")


def age_on(birth: Column, day: Column) -> Column:
    """Full years between two dates; 0 when the birth date is unknown.

    A birthday on 29 February is reached on 1 March in other years, which is why
    ``months_between`` is not used.
    """
    not_reached = F.date_format(day, "MMdd") < F.date_format(birth, "MMdd")
    return F.coalesce(F.year(day) - F.year(birth) - not_reached.cast("int"), F.lit(0))


def digits_or_zero(text: Column) -> Column:
    """The integer a digits-only text stands for, else 0."""
    return F.coalesce(F.when(text.rlike(r"\A[0-9]+\z"), text).try_cast("int"), F.lit(0))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def number_of(text: Column) -> Column:
    """The numeric value of a numeric text as double, else NULL."""
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text)).try_cast("double")


def whole_number(text: Column) -> Column:
    """A numeric text cut to a whole number, else NULL. Large whole ids keep every digit."""
    return F.coalesce(
        F.when(text.rlike(NUMBER_PATTERN), F.trim(text)).try_cast("bigint"),
        number_of(text).try_cast("bigint"),
    )


def lesson_month(day: Column) -> Column:
    """Month bucket yyyyMM as text."""
    return F.date_format(day, "yyyyMM")


def in_range(value: Column, kind: str, low: int, high: int) -> Column:
    """Value as ``kind`` when it lies within the bounds, else NULL."""
    typed = value.try_cast(kind)
    return F.when(typed.between(low, high), typed)


def micros_text(ts: Column) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss.SSSSSS``, without going through the session zone."""
    text = ts.cast("string")
    whole = F.substring(text, 1, 19)
    return F.concat(whole, F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0"))


def time_of_day(ts: Column) -> Column:
    """Clock time as text; compares correctly with other clock times as text."""
    return F.substring(ts.cast("string"), 12, 15)


def stable_id(*parts: Column) -> Column:
    """Identifier in UUID form derived from the natural key, so replays give the same id."""
    text = F.concat_ws("\u0001", *[F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts])
    return F.regexp_replace(
        F.substring(F.sha2(text, 256), 1, 32),
        r"\A(.{8})(.{4})(.{4})(.{4})(.{12})\z",
        "$1-$2-$3-$4-$5",
    )


"""Durations, calendar parts, guarded dates and ages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F


def as_timestamp(value: Column) -> Column:
    return value.cast("timestamp")


def parse_timestamp(text: Column, fmt: str | None = None) -> Column:
    """Unparsable text is NULL."""
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def minute_timestamp(text: Column) -> Column:
    return parse_timestamp(text, "yyyy-MM-dd HH:mm")


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def monday_weekday(ts: Column) -> Column:
    return F.weekday(ts)


def four_hour_block(ts: Column) -> Column:
    return (F.floor(F.hour(ts) / 4) * 4).cast("int")


def calendar_parts(value: Column, name: str) -> list[Column]:
    return [F.year(value).alias(f"{name}_y"), F.month(value).alias(f"{name}_m"),
            F.dayofmonth(value).alias(f"{name}_d")]


def is_date_column(name: str) -> bool:
    return "_date" in name or "_year" in name


def guarded_birthdate(text: Column, as_of: date) -> Column:
    """A birth year after the reference year makes the date missing."""
    year = F.split_part(text, F.lit("-"), F.lit(1)).try_cast("int")
    return F.when(year <= as_of.year, F.try_to_timestamp(text))


def whole_years(start: Column, end: Column) -> Column:
    """Whole days between the instants, floor-divided by 365; negative spans round down."""
    days = F.floor(seconds_between(start, end) / 86400)
    return F.floor(days / 365).cast("int")

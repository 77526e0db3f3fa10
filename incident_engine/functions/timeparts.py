"""Timestamp expressions (Column -> Column). All timestamps are zone-less."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from incident_engine.constants import DAY_ORDER

TIMESTAMP_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\z"


def parse_timestamp(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, padded or not; anything else is null.

    The cast accepts more shapes than the format (dates alone, fractions, outer blanks), so the
    shape is tested first. It needs no session zone and is cheaper than a pattern formatter.
    """
    return F.when(text.rlike(TIMESTAMP_SHAPE), text.try_cast("timestamp_ntz"))


def cast_timestamp(text: Column) -> Column:
    """:func:`parse_timestamp` for texts already known to parse: no second shape test."""
    return text.try_cast("timestamp_ntz")


def weekday_index(ts: Column) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(ts)


def weekday_number(ts: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(ts) + 1


def weekday_name(index: Column) -> Column:
    """Name of a weekday index; independent of locale and session zone (T4)."""
    return F.element_at(F.array(*map(F.lit, DAY_ORDER)), index + 1)


def weekday_position(name: Column) -> Column:
    """Sort key of a weekday name, Monday first; 0 for any other text."""
    return F.array_position(F.array(*map(F.lit, DAY_ORDER)), name)


PARTS = {
    "hour_of_day": F.hour,
    "day_of_week": weekday_number,
    "month": F.month,
    "year": F.year,
}


def time_part(ts: Column, part: str) -> Column:
    """One of ``hour_of_day``, ``day_of_week``, ``month``, ``year``."""
    if part not in PARTS:
        raise ValueError(f"unknown time part {part!r}; expected one of {sorted(PARTS)}")
    return PARTS[part](ts)

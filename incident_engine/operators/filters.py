"""Predicates used by the result views."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_engine import constants as C
from incident_engine.functions.text import lower_contains

ALL = "ALL"


def by_members(df: DataFrame, column: str, allowed: Collection[str] | str | None) -> DataFrame:
    """Keep rows whose ``column`` is among ``allowed``.

    A list selects its members (an empty list selects nothing), a single text selects that
    value, ``None`` and ``'ALL'`` select everything.
    """
    if allowed is None or allowed == ALL:
        return df
    if isinstance(allowed, str):
        return df.where(F.col(column) == allowed)
    return df.where(F.col(column).isin(*allowed))


def by_type_and_day(
    time_type: DataFrame,
    types: Collection[str] | str | None = None,
    days: Collection[str] | str | None = None,
) -> DataFrame:
    """Rows of the day x hour x type table for selected types and days."""
    return by_members(by_members(time_type, "Violation_Type", types), "DayOfWeek", days)


def critical_hours(hourly: DataFrame) -> DataFrame:
    """Hours classed as critical."""
    return hourly.where(F.col("anomaly_level") == C.CRITICAL)


def search_rows(df: DataFrame, query: str, *columns: str) -> DataFrame:
    """Rows whose shown text contains ``query``, ignoring case (F8); an empty query keeps all."""
    return df.where(lower_contains(F.concat_ws("\t", *columns), query))

"""Counts and rankings per location text.

A location that holds a large share of all rows is folded into one row per task before the
shuffle (partial aggregation), so it never becomes one large group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_engine.operators.common import descending_then, incidents, top_k


def location_counts(
    df: DataFrame, column: str = "Location", weight: str | None = None
) -> DataFrame:
    """Rows per location, null locations left out, in no particular order (A4)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("Location"))
        .agg(incidents(weight).alias("count"))
    )


def rank_locations(counts: DataFrame) -> DataFrame:
    """A location count table, most frequent first (O3)."""
    return counts.orderBy(*descending_then("count", "Location"))


def violations_per_location(
    df: DataFrame, column: str = "Location", weight: str | None = None
) -> DataFrame:
    """Rows per location, most frequent first."""
    return rank_locations(location_counts(df, column, weight))


def top_locations(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent locations of a location count table (L1, L2)."""
    return top_k(counts, n, "count", "Location")

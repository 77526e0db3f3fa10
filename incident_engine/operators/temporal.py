"""Counts over time parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_engine.functions import timeparts
from incident_engine.operators.cleaning import parsed_only
from incident_engine.operators.common import incidents, short_sorted


def count_by(clean: DataFrame, part: str = "hour_of_day", weight: str | None = None) -> DataFrame:
    """Incidents per hour, weekday, month or year, in order."""
    key = timeparts.time_part(F.col("timestamp_parsed"), part).alias(part)
    return short_sorted(clean.groupBy(key).agg(incidents(weight).alias("count")), part)


def day_order(column: str = "DayOfWeek") -> Column:
    """Sort key that puts weekday names in Monday-first order."""
    return timeparts.weekday_position(F.col(column))


def weekday_hour_type_counts(
    df: DataFrame,
    ts: str = "timestamp_parsed",
    kind: str = "violation_type",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Rows per weekday index, hour and type, null types kept: the finest time aggregate.

    At most 168 rows per type, and every hourly, daily or per-type result can be summed from it.
    """
    stamp = F.col(ts)
    return (
        parsed_only(df, ts)
        .groupBy(
            *extra,
            timeparts.weekday_index(stamp).alias("weekday"),
            F.hour(stamp).alias("Hour"),
            F.col(kind).alias("violation_type"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def named_time_type(counts: DataFrame) -> DataFrame:
    """Day x hour x type table, unordered, summed from :func:`weekday_hour_type_counts` (A3)."""
    return (
        counts.where(F.col("violation_type").isNotNull())
        .groupBy("weekday", "Hour", "violation_type")
        .agg(F.sum("n").alias("count"))
        .select(
            timeparts.weekday_name(F.col("weekday")).alias("DayOfWeek"),
            "Hour",
            F.col("violation_type").alias("Violation_Type"),
            "count",
        )
    )


def time_type_counts(raw: DataFrame) -> DataFrame:
    """Rows per weekday name, hour and type of the raw table, unordered (A3).

    Rows without id or location count, rows without a readable timestamp or a type do not.
    """
    text = F.col("Timestamp")
    stamp = timeparts.cast_timestamp(text)
    return (
        raw.where(
            timeparts.parse_timestamp(text).isNotNull() & F.col("Violation_Type").isNotNull()
        )
        .groupBy(
            timeparts.weekday_index(stamp).alias("weekday"),
            F.hour(stamp).alias("Hour"),
            "Violation_Type",
        )
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            timeparts.weekday_name(F.col("weekday")).alias("DayOfWeek"),
            "Hour",
            "Violation_Type",
            "count",
        )
    )


def time_type_aggregation(raw: DataFrame) -> DataFrame:
    """:func:`time_type_counts` from Monday to Sunday, then by hour and type."""
    return time_type_counts(raw).orderBy(day_order(), "Hour", "Violation_Type")

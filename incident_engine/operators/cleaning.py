"""Raw text rows -> typed incidents. Projections and filters only: no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_engine.functions.timeparts import cast_timestamp, parse_timestamp

REQUIRED = ("violation_id", "timestamp_parsed", "location")


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip blanks around column names."""
    return df.toDF(*(c.strip() for c in df.columns))


def underscore_headers(df: DataFrame) -> DataFrame:
    """Strip column names and turn inner blanks into underscores."""
    return df.toDF(*(c.strip().replace(" ", "_") for c in df.columns))


def to_clean_columns(
    raw: DataFrame,
    parse: Callable[[Column], Column] = parse_timestamp,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Rename and parse into the four cleaned columns, keeping every row.

    ``extra`` columns go along.
    """
    return raw.select(
        F.col("Violation_Id").cast("string").alias("violation_id"),
        parse(F.col("Timestamp")).alias("timestamp_parsed"),
        F.col("Violation_Type").alias("violation_type"),
        F.col("Location").alias("location"),
        *extra,
    )


def is_complete() -> Column:
    """Whether a row has id, timestamp and location (F1). The type may be missing."""
    present = [F.col(c).isNotNull() for c in REQUIRED]
    return present[0] & present[1] & present[2]


def clean(raw: DataFrame) -> DataFrame:
    """Typed incidents, rows without id, timestamp or location removed.

    The rows are selected by their text, so that the shape of a timestamp is tested once: a
    filter on the parsed column would be pushed below the projection and parse again there.
    """
    kept = raw.where(
        F.col("Violation_Id").isNotNull()
        & F.col("Location").isNotNull()
        & parse_timestamp(F.col("Timestamp")).isNotNull()
    )
    return to_clean_columns(kept, cast_timestamp)


def with_acceptance(raw: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Every row in cleaned form, with ``accepted`` telling whether :func:`clean` keeps it."""
    return to_clean_columns(raw, extra=extra).withColumn("accepted", is_complete())


def parsed_only(df: DataFrame, column: str = "timestamp_parsed") -> DataFrame:
    """Drop rows whose timestamp is missing or failed to parse (F2)."""
    return df.where(F.col(column).isNotNull())


def ensure_timestamp(df: DataFrame, source: str = "timestamp") -> DataFrame:
    """Add ``timestamp_parsed`` from a text column in any ISO form when it is absent."""
    if "timestamp_parsed" in df.columns:
        return df
    return df.withColumn("timestamp_parsed", F.col(source).try_cast("timestamp_ntz"))


def reject_counts(raw: DataFrame) -> DataFrame:
    """One row: how many rows fail each cleaning rule, how many pass, how many there are."""
    missing = {c: F.count_if(F.col(c).isNull()) for c in REQUIRED}
    return with_acceptance(raw).agg(
        missing["violation_id"].alias("missing_id"),
        missing["timestamp_parsed"].alias("bad_timestamp"),
        missing["location"].alias("missing_location"),
        F.count_if("accepted").alias("accepted"),
        F.count(F.lit(1)).alias("total"),
    )

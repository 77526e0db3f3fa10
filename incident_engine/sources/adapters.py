"""Raw incidents derived from a table of user events, by integer arithmetic only."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Types by index, hotspot positions in millionths of a degree (longitudes west).
EVENT_TYPES = (
    "DUI", "Reckless Driving", "Red Light Violation", "Speeding", "Using Mobile Phone",
    "Illegal Turn", "Seatbelt Violation", "Broken Tail Light",
)
LAT_MICRO = (40758000, 40729500, 40748400, 40706100, 40807500)
LON_MICRO = (73985500, 73996500, 73985700, 74008800, 73962600)


def _pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _degrees(micro: Column) -> Column:
    """Millionths of a degree as text with six decimals."""
    return (micro.cast("decimal(12,0)") * F.lit(Decimal("0.000001"))).cast("string")


def violations_from_events(events: DataFrame, *extra: Column) -> DataFrame:
    """Raw incidents with repeated places, padded and missing types and all kinds of rejects.

    ``extra`` columns of the events go along.
    """
    event, user = F.col("event_id"), F.col("user_id")

    def every(n: int) -> Column:
        return event % n == 0

    kind = _pick(EVENT_TYPES, (event * 31 + user) % len(EVENT_TYPES))
    lat = _pick(LAT_MICRO, user % 5) + ((event * 7919) % 21 - 10) * 1000
    lon = -_pick(LON_MICRO, user % 5) - ((event * 104729) % 5 - 2) * 1000
    return events.select(
        F.when(~every(103), F.format_string("V%04d", event)).alias("Violation_Id"),
        F.when(every(97), "not-a-date")
        .otherwise(F.substring(F.col("ts").cast("string"), 1, 19))
        .alias("Timestamp"),
        F.when(
            ~every(61),
            F.when(every(53), F.concat(F.lit(" "), kind, F.lit(" "))).otherwise(kind),
        ).alias("Violation_Type"),
        F.when(
            ~every(101),
            F.when(every(89), "Main St & 5th Ave").otherwise(
                F.concat_ws(",", _degrees(lat), _degrees(lon))
            ),
        ).alias("Location"),
        *extra,
    )

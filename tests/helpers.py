"""Small frames used by several tests."""

import datetime as dt

from incident_engine import constants as C


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, C.RAW_SCHEMA)


def clean_frame(spark, rows):
    return spark.createDataFrame(rows, C.CLEAN_SCHEMA)


def hundred_incidents(spark):
    """100 hourly incidents at one place; DUI on even, Seatbelt Violation on odd positions."""
    start = dt.datetime(2026, 1, 1)
    return clean_frame(
        spark,
        [
            (
                f"V{i:04d}",
                start + dt.timedelta(hours=i),
                "DUI" if i % 2 == 0 else "Seatbelt Violation",
                "40.7580,-73.9855",
            )
            for i in range(100)
        ],
    )


def at_hour(hour, kind="DUI", place="40.7580,-73.9855", day=5, name="V1"):
    return (name, dt.datetime(2026, 1, day, hour), kind, place)


def point_frame(spark, points, kind="DUI"):
    rows = [(f"V{i:04d}", float(a), float(b), kind) for i, (a, b) in enumerate(points)]
    return spark.createDataFrame(
        rows, "violation_id string, lat double, lon double, violation_type string"
    )


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]

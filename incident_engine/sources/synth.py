"""Seeded synthetic incidents: a projection over ids, so any number of rows in parallel."""

from __future__ import annotations

import datetime as dt
import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_engine import constants as C
from incident_engine.functions.text import zero_padded

# Each draw takes 8 hex digits of a digest; a digest has room for four draws.
DRAWS_PER_DIGEST = 4
DRAW_RANGE = float(2**32)


def uniform(row_id: Column, draw: int, seed: int) -> Column:
    """Number in [0, 1) that depends on row id, draw and seed only, not on partitioning."""
    block, place = divmod(draw, DRAWS_PER_DIGEST)
    digest = F.md5(F.concat(F.lit(f"{seed}:{block}:"), row_id.cast("string")))
    digits = F.substring(digest, 8 * place + 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(DRAW_RANGE)


def pick_index(u: Column, weights: tuple[int, ...]) -> Column:
    """Index drawn with the given integer weights."""
    bounds = list(accumulate(weights))
    point = u * F.lit(float(bounds[-1]))
    passed = [F.when(point >= F.lit(float(b)), 1).otherwise(0) for b in bounds[:-1]]
    index = passed[0]
    for step in passed[1:]:
        index = index + step
    return index


def normal_pair(u1: Column, u2: Column) -> tuple[Column, Column]:
    """Two independent standard normals by the Box-Muller transform."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(u1 + F.lit(1.0 / DRAW_RANGE)))
    angle = F.lit(2.0 * math.pi) * u2
    return radius * F.cos(angle), radius * F.sin(angle)


def synthesize_from_ids(
    ids: DataFrame, column: str, anchor: dt.date, seed: int = 42
) -> DataFrame:
    """One raw incident per id of a table.

    Days are uniform over 61 days from ``anchor``, hours follow the fixed daily profile, types
    and hotspots are uniform, positions scatter normally around the hotspot.
    """
    row_id = F.col(column)
    u = [uniform(F.col("row_id"), i, seed) for i in range(8)]
    day = F.date_add(F.lit(anchor), F.floor(u[0] * C.SYNTH_DAYS).cast("int"))
    minute, second = (F.floor(v * 60) for v in (u[2], u[3]))
    kind = F.floor(u[4] * len(C.SYNTH_TYPES)).cast("int") + 1
    spot = F.floor(u[5] * len(C.HOTSPOTS)).cast("int") + 1
    d_lat, d_lon = normal_pair(u[6], u[7])

    def axis(position: int, offset: Column) -> Column:
        centres = F.array(*(F.lit(h[position]) for h in C.HOTSPOTS))
        return F.element_at(centres, spot) + F.lit(C.SYNTH_JITTER) * offset

    def two(number: Column) -> Column:
        return zero_padded(number, 2)

    def six_decimals(degrees: Column) -> Column:
        return degrees.cast("decimal(10,6)").cast("string")

    clock = F.concat_ws(":", two(pick_index(u[1], C.HOUR_WEIGHTS)), two(minute), two(second))
    return ids.select(row_id.cast("bigint").alias("row_id")).select(
        F.concat(F.lit("V"), zero_padded(F.col("row_id"), 4)).alias("Violation_Id"),
        F.concat_ws(" ", day.cast("string"), clock).alias("Timestamp"),
        F.element_at(F.array(*map(F.lit, C.SYNTH_TYPES)), kind).alias("Violation_Type"),
        F.concat_ws(",", six_decimals(axis(0, d_lat)), six_decimals(axis(1, d_lon))).alias(
            "Location"
        ),
    )


def synthesize(
    spark: SparkSession,
    n: int = 1500,
    anchor: dt.date | None = None,
    seed: int = 42,
    partitions: int | None = None,
) -> DataFrame:
    """``n`` raw incidents with ids from 1 (S9). ``anchor`` is required, so that runs repeat."""
    if anchor is None:
        raise ValueError("give the first day as anchor")
    return synthesize_from_ids(spark.range(1, n + 1, 1, partitions), "id", anchor, seed)

"""Coordinate expressions (Column -> Column). Distances are Euclidean, in degrees."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from incident_engine.constants import CELLS_PER_DEGREE, COORDINATE_PATTERN

METRES_PER_DEGREE = 111_320.0


def is_coordinate_pair(location: Column) -> Column:
    """Whether a text is ``lat,lon`` with decimals and no blanks.

    ``(?d)`` makes ``$`` accept a newline as the only line terminator.
    """
    return location.rlike("(?d)" + COORDINATE_PATTERN)


def coordinate(location: Column, position: int) -> Column:
    """Number at ``position`` of a ``lat,lon`` text."""
    return F.split(location, ",").getItem(position).try_cast("double")


def grid_index(degrees: Column, cells_per_degree: float = CELLS_PER_DEGREE) -> Column:
    """Cell number along one axis, floored toward minus infinity."""
    return F.floor(degrees * cells_per_degree)


def distance(lat: Column, lon: Column, centre: Sequence[float]) -> Column:
    """Euclidean distance in degrees to a fixed centre."""
    d_lat, d_lon = lat - F.lit(float(centre[0])), lon - F.lit(float(centre[1]))
    return F.sqrt(d_lat * d_lat + d_lon * d_lon)


def nearest_centre(lat: Column, lon: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest centre; the lowest index wins ties.

    The few centres are literals, so the assignment is a projection: no join and no shuffle.
    """
    distances = F.array(*(distance(lat, lon, c) for c in centres))
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


class HexGrid(NamedTuple):
    """Pointy-top hexagons of a given circumradius on a flat map.

    Degrees become metres by two constant factors, the one for longitude taken at
    ``reference_latitude``; hexagons are numbered by axial coordinates ``(q, r)``.
    """

    radius_m: float = 140.0
    reference_latitude: float = 40.75

    @property
    def metres_per_lon(self) -> float:
        return METRES_PER_DEGREE * math.cos(math.radians(self.reference_latitude))

    def cell(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        """Axial coordinates of the hexagon that holds a point (cube rounding)."""
        x, y = lon * F.lit(self.metres_per_lon), lat * F.lit(METRES_PER_DEGREE)
        q = (x * F.lit(math.sqrt(3) / 3) - y / F.lit(3.0)) / F.lit(self.radius_m)
        r = y * F.lit(2.0 / 3.0) / F.lit(self.radius_m)
        s = -q - r
        q0, r0, s0 = (F.floor(v + F.lit(0.5)) for v in (q, r, s))
        off_q, off_r, off_s = F.abs(q0 - q), F.abs(r0 - r), F.abs(s0 - s)
        q_is_worst = (off_q > off_r) & (off_q > off_s)
        return (
            F.when(q_is_worst, -r0 - s0).otherwise(q0),
            F.when(~q_is_worst & (off_r > off_s), -q0 - s0).otherwise(r0),
        )

    def centre(self, q: Column, r: Column) -> tuple[Column, Column]:
        """Latitude and longitude of a hexagon's centre, rounded to 6 decimals."""
        x = (q + r / F.lit(2.0)) * F.lit(math.sqrt(3) * self.radius_m)
        y = r * F.lit(1.5 * self.radius_m)
        return (
            F.round(y / F.lit(METRES_PER_DEGREE), 6),
            F.round(x / F.lit(self.metres_per_lon), 6),
        )

"""Coordinates, grid cells and hexagons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_engine.constants import CELLS_PER_DEGREE
from incident_engine.functions import geo
from incident_engine.operators.common import descending_then, incidents, top_k


def extract_coordinates(clean: DataFrame, column: str = "location") -> DataFrame:
    """Rows whose location is a coordinate pair, with ``lat`` and ``lon``."""
    text = F.col(column)
    return clean.where(geo.is_coordinate_pair(text)).withColumns(
        {"lat": geo.coordinate(text, 0), "lon": geo.coordinate(text, 1)}
    )


def numeric_coordinates(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Keep rows whose coordinates read as numbers, and cast them."""
    return df.withColumns(
        {lat: F.col(lat).try_cast("double"), lon: F.col(lon).try_cast("double")}
    ).where(
        F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    )


def grid_counts(
    points: DataFrame, cells_per_degree: float = CELLS_PER_DEGREE, weight: str | None = None
) -> DataFrame:
    """Incidents per square cell, fullest first.

    Cells are grouped by two integers; the ``x_y`` name is made once per cell afterwards.
    """
    return (
        points.groupBy(
            geo.grid_index(F.col("lat"), cells_per_degree).alias("grid_x"),
            geo.grid_index(F.col("lon"), cells_per_degree).alias("grid_y"),
        )
        .agg(incidents(weight).alias("count"))
        .select(F.concat_ws("_", "grid_x", "grid_y").alias("grid_id"), "count")
        .orderBy(*descending_then("count", "grid_id"))
    )


def top_grids(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` fullest cells of a grid count table."""
    return top_k(counts, n, "count", "grid_id")


def hexbin_density(
    points: DataFrame, grid: geo.HexGrid = geo.HexGrid(), weight: str | None = None
) -> DataFrame:
    """Incidents per hexagon with the hexagon's centre."""
    q, r = grid.cell(F.col("lat"), F.col("lon"))
    cells = points.groupBy(q.alias("hex_q"), r.alias("hex_r")).agg(
        incidents(weight).alias("count")
    )
    lat, lon = grid.centre(F.col("hex_q"), F.col("hex_r"))
    return cells.select("hex_q", "hex_r", lat.alias("center_lat"), lon.alias("center_lon"), "count")

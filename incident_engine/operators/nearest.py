"""Nearest centre from a table of centres (J4): a grid of cells searched from coarse to fine.

One square holds all points and centres. It is cut into 4 x 4 cells, these again, and so on. Each cell that holds
points keeps the cells of centres that may hold a nearest one: those whose least distance does not exceed the
least of all greatest distances. A step joins these pairs with the next finer cells of both sides by equal
parent cells and drops what the bounds rule out, so only pairs of cells near each other are ever made. In the
last step the distinct places meet the centres of the few cells left. There is no cross join, and far, dense or
empty regions need no other way.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_engine.operators.lookups import lookup_table
from incident_engine.scratch import cut_lineage

#: Bits by which a cell's coordinates grow in a step: 4 x 4 cells in each.
BITS = 2
#: Steps end when no cell has more centres than this, or at this depth (a cell is then 4 ** -13 of the square).
LEAF, DEPTH = 8, 13
#: Tables up to this number of rows (of at most 48 bytes) are sent to every task instead of being shuffled.
BROADCAST_ROWS = 200_000
#: Keys under which a row of the smaller table is found in a shuffled join, as very many rows may need it.
SALTS = 16
#: Bounds are widened by this part of the square, far above the rounding of doubles.
SLACK = 1e-12


class _Square:
    """The square of all points and centres, and its cells at a depth."""

    def __init__(self, lat: float, lon: float, side: float):
        self.lat, self.lon, self.side = lat, lon, side

    @staticmethod
    def around(*frames: DataFrame) -> _Square | None:
        both = frames[0].select("lat", "lon")
        for frame in frames[1:]:
            both = both.unionByName(frame.select("lat", "lon"))
        low_lat, high_lat, low_lon, high_lon = both.agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
        if low_lat is None:
            return None
        side = max(high_lat - low_lat, high_lon - low_lon)
        return _Square(low_lat, low_lon, math.nextafter(side, math.inf) if side > 0 else 1.0)

    def cells(self, depth: int) -> float:
        return float(1 << BITS * depth)

    def index(self, axis: str, depth: int) -> Column:
        """Cell number along one axis; the upper edge counts to the last cell."""
        at = F.floor((F.col(axis) - F.lit(getattr(self, axis))) / F.lit(self.side) * F.lit(self.cells(depth)))
        return F.greatest(F.lit(0), F.least(at, F.lit((1 << BITS * depth) - 1))).cast("long")

    def size(self, depth: int) -> float:
        return self.side / self.cells(depth)


def _parents(cells: DataFrame, x: str, y: str, steps: int) -> DataFrame:
    shift = BITS * steps
    return cells.select(F.shiftright(x, shift).alias(x), F.shiftright(y, shift).alias(y)).distinct()


def _joined(rows: DataFrame, table: DataFrame, keys: list[str], few: bool, salted_by: list[str]) -> DataFrame:
    """`rows` with all rows of equal keys in `table`, which is broadcast if it has few rows and salted if not."""
    if few:
        return rows.join(F.broadcast(table), keys)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*salted_by), F.lit(SALTS)).cast("int"))
    return salted.join(table.select("*", salts), [*keys, "salt"]).drop("salt")


def _refined(pairs: DataFrame, points: DataFrame, centres: DataFrame, size: float, slack: float, few: bool) -> DataFrame:
    """The pairs of the next depth that the bounds leave: (px, py) of points, (cx, cy) of centres."""
    up = [F.shiftright(c, BITS).alias(f"{c}_up") for c in ("px", "py")]
    down = [F.shiftright(c, BITS).alias(f"{c}_up") for c in ("cx", "cy")]
    parents = pairs.select(*(F.col(c).alias(f"{c}_up") for c in ("px", "py", "cx", "cy")))
    fine = parents.join(points.select("px", "py", *up), ["px_up", "py_up"])
    wide = _joined(fine, centres.select("cx", "cy", *down), ["cx_up", "cy_up"], few, ["px", "py"])
    apart = [F.abs(F.col(a) - F.col(b)).cast("double") for a, b in (("px", "cx"), ("py", "cy"))]
    least = [F.greatest(a - 1.0, F.lit(0.0)) * F.lit(size) for a in apart]
    most = [(a + 1.0) * F.lit(size) for a in apart]
    low, high = (F.sqrt(x * x + y * y) for x, y in (least, most))
    bounded = wide.select("px", "py", "cx", "cy", (low - F.lit(slack)).alias("low"), (high + F.lit(slack)).alias("high"))
    best = F.min("high").over(Window.partitionBy("px", "py"))
    return bounded.withColumn("best", best).where("low <= best").select("px", "py", "cx", "cy")


def _depth(placed: DataFrame) -> tuple[int, int]:
    """The first depth at which no cell has over LEAF centres (or DEPTH), and the number of centres."""
    levels = placed.select("cx", "cy", F.explode(F.sequence(F.lit(1), F.lit(DEPTH))).alias("depth"))
    cell = [F.expr(f"shiftright({c}, {BITS} * ({DEPTH} - depth))").alias(c) for c in ("cx", "cy")]
    counts = levels.groupBy("depth", *cell).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.groupBy("depth").agg(F.max("n").alias("most"), F.sum("n").alias("n")).collect()
    return min((r["depth"] for r in rows if r["most"] <= LEAF), default=DEPTH), rows[0]["n"]


def distinct_centres(centres: DataFrame) -> DataFrame:
    """One centre per place, that of the lowest id; centres without id or a whole, finite place are left out."""
    finite = [~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))) for c in ("center_lat", "center_lon")]
    placed = centres.where(F.col("cluster_id").isNotNull() & finite[0] & finite[1])
    return placed.groupBy(F.col("center_lat").alias("lat"), F.col("center_lon").alias("lon")).agg(
        F.min("cluster_id").alias("cluster_id")
    )


def nearest_places(places: DataFrame, centres: DataFrame) -> DataFrame:
    """lat, lon, prediction, distance: the nearest centre of each of some distinct places.

    `centres` has `cluster_id`, `center_lat` and `center_lon`. Distances are Euclidean, in degrees; ties go to
    the lowest id. Places with a null, infinite or NaN coordinate get none. Without centres there are no rows.
    """
    finite = [~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))) for c in ("lat", "lon")]
    places = cut_lineage(places.where(finite[0] & finite[1]).select("lat", "lon").distinct())
    spots = cut_lineage(distinct_centres(centres))
    square = _Square.around(places, spots) if not spots.isEmpty() else None
    if square is None:
        kind = centres.schema["cluster_id"].dataType
        none = F.lit(None).cast(kind).alias("prediction"), F.lit(None).cast("double").alias("distance")
        return places.where("false").select("lat", "lon", *none)
    at = [square.index(c, DEPTH).alias(x) for c, x in (("lat", "cx"), ("lon", "cy"))]
    placed = spots.select("cluster_id", "lat", "lon", *at)
    depth, n = _depth(placed)
    own = [square.index(c, depth).alias(x) for c, x in (("lat", "px"), ("lon", "py"))]
    points = places.select("lat", "lon", *own)
    cells = cut_lineage(points.select("px", "py").distinct())
    leaf = [F.shiftright(c, BITS * (DEPTH - depth)).alias(c) for c in ("cx", "cy")]
    centre_cells = placed.select(*leaf, "cluster_id", F.col("lat").alias("to_lat"), F.col("lon").alias("to_lon"))
    few = n <= BROADCAST_ROWS
    zero = F.lit(0).cast("long")
    pairs = _parents(cells, "px", "py", depth).select("px", "py", zero.alias("cx"), zero.alias("cy"))
    for d in range(1, depth + 1):
        fine, others = _parents(cells, "px", "py", depth - d), _parents(centre_cells, "cx", "cy", depth - d)
        pairs = cut_lineage(_refined(pairs, fine, others, square.size(d), square.side * SLACK, few))
    near = cut_lineage(_joined(pairs, centre_cells, ["cx", "cy"], few, ["px", "py"]).drop("cx", "cy"))
    few = near.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    met = _joined(points, near, ["px", "py"], few, ["lat", "lon"])
    d_lat, d_lon = F.col("lat") - F.col("to_lat"), F.col("lon") - F.col("to_lon")
    best = F.min(F.struct(F.sqrt(d_lat * d_lat + d_lon * d_lon).alias("distance"), "cluster_id"))
    found = met.groupBy("lat", "lon").agg(best.alias("best"))
    return found.select("lat", "lon", F.col("best.cluster_id").alias("prediction"), "best.distance")


def nearest_in_table(points: DataFrame, centres: DataFrame) -> DataFrame:
    """`points` with `prediction` and `distance` of the nearest of a table of centres.

    Every row of `points` stays, with nulls where it has no finite place or there are no centres. Distances
    are worked out once per distinct place; see :func:`nearest_places` for ties.
    """
    found = cut_lineage(nearest_places(points, centres))
    return lookup_table(points, found, {"lat": F.col("lat"), "lon": F.col("lon")}, {"prediction": None, "distance": None})

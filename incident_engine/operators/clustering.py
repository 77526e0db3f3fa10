"""Hotspot clustering: distributed k-means, Lloyd iterations and cluster summaries.

Both algorithms run on distinct coordinates with a weight instead of single incidents. The
objective is the same, a coordinate that holds a third of all incidents is one row, and every
iteration reads the compact table only. The driver holds nothing but the k centres and, while
k-means starts, the few times k candidates. All draws are hashes of a seed and the place, so results
depend neither on file layout nor on the number of tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_engine import constants as C
from incident_engine.functions import geo
from incident_engine.operators.common import incidents, largest, short_sorted, total
from incident_engine.scratch import cut_lineage

Centres = Sequence[Sequence[float]]
Places = list[tuple[float, float]]
#: Rounds of candidates for the start of k-means, and candidates expected of a round, times k.
ROUNDS, OVERSAMPLING = 3, 2


def weighted_points(points: DataFrame, weight: str | None = None) -> DataFrame:
    """Distinct coordinates with the number of incidents at each."""
    return points.groupBy("lat", "lon").agg(incidents(weight).cast("double").alias("weight"))


def has_at_least(df: DataFrame, n: int) -> bool:
    """Whether a frame has ``n`` rows; reads partitions only until it has seen them."""
    return len(df.select(F.lit(1)).take(n)) >= n


def assign_nearest(points: DataFrame, centres: Centres) -> DataFrame:
    """Add ``prediction``: the index of the nearest centre."""
    return points.withColumn("prediction", geo.nearest_centre(F.col("lat"), F.col("lon"), centres))


def feature_vectors(points: DataFrame, columns: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """Add ``features``: numeric columns as one vector, for Spark's own learners (H3)."""
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(points)


def draw(seed: int, turn: int) -> Column:
    """A number in [0, 1) for each place: 32 bits of a hash of seed, turn and place in millionths of a degree."""
    place = [F.round(F.col(c) * 1e6).cast("bigint").cast("string") for c in ("lat", "lon")]
    text = F.md5(F.concat(F.lit(f"{seed}:{turn}:"), place[0], F.lit(","), place[1]))
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def _squared(centres: Centres) -> Column:
    """Squared distance to the nearest of some centres."""
    gaps = [(F.col("lat") - F.lit(a), F.col("lon") - F.lit(b)) for a, b in centres]
    return F.array_min(F.array(*(x * x + y * y for x, y in gaps)))


def _spread_out(candidates: Sequence[tuple[float, float, float]], k: int) -> Places:
    """``k`` of the (lat, lon, weight): the heaviest, then those of most weight times squared distance."""
    left = {(a, b): (w, float("inf")) for a, b, w in candidates}
    chosen: Places = []
    while left and len(chosen) < k:
        best = min(left, key=lambda c: (-left[c][0] * (left[c][1] if chosen else 1.0), c))
        chosen.append(best)
        del left[best]
        for c, (w, d) in left.items():
            x, y = c[0] - best[0], c[1] - best[1]
            left[c] = w, min(d, x * x + y * y)
    return chosen


def kmeans_start(compact: DataFrame, k: int, seed: int = 42, rounds: int = ROUNDS) -> Places:
    """Start centres by k-means||: few rounds of candidates, weighted and reduced to ``k`` (H4).

    ``compact`` holds distinct places with a ``weight``. The first candidate has the least draw. A round
    takes each place with a probability of its share in the cost (weight times squared distance to the
    nearest candidate) times twice ``k``, by a hash draw of its own, so it finds about 2 ``k`` places,
    far ones first. Each candidate then gets the weight of all places nearest to it.
    """
    row = compact.orderBy(draw(seed, 0), "lat", "lon").select("lat", "lon").first()
    found: Places = [(row["lat"], row["lon"])]
    turn = 0
    while turn < rounds or len(found) < k:
        turn += 1
        cost = F.col("weight") * _squared(found)
        total_cost = compact.agg(F.sum(cost)).scalar()
        taken = compact.where(draw(seed, turn) * total_cost < cost * F.lit(float(OVERSAMPLING * k)))
        new = taken.select("lat", "lon").collect()
        if not new and turn > rounds:  # too few by chance: the places of most cost fill up
            new = compact.where(cost > 0).orderBy(cost.desc(), "lat", "lon").select("lat", "lon").take(k)
            if not new:
                break
        found += sorted((r["lat"], r["lon"]) for r in new)
    shares = assign_nearest(compact, found).groupBy("prediction").agg(F.sum("weight").alias("weight"))
    weights = {r["prediction"]: r["weight"] for r in shares.collect()}
    return _spread_out([(*c, weights.get(i, 0.0)) for i, c in enumerate(found)], k)


def kmeans_centres(
    points: DataFrame,
    k: int = 5,
    seed: int = 42,
    max_iter: int = 100,
    weight: str | None = None,
    rounds: int = ROUNDS,
) -> Places:
    """Centres found by distributed k-means, ordered by latitude and longitude (H4).

    A k-means|| start of hash draws, then Lloyd's iterations until the centres settle. With at most ``k``
    distinct places, these are the centres; no more than ``k + 1`` of them reach the driver to tell.
    """
    compact = cut_lineage(weighted_points(points, weight)).persist()
    try:
        places = [(float(r["lat"]), float(r["lon"])) for r in compact.select("lat", "lon").take(k + 1)]
        if len(places) <= k:
            return sorted(places)
        return sorted(_iterate(compact, kmeans_start(compact, k, seed, rounds), max_iter).centres)
    finally:
        compact.unpersist()


def cluster_hotspots(
    points: DataFrame, k: int = 5, seed: int = 42, weight: str | None = None, **options
) -> DataFrame:
    """Points labelled by k-means; with fewer than ``k`` points all labels are 0."""
    if not has_at_least(points, k):
        return points.withColumn("prediction", F.lit(0))
    return assign_nearest(points, kmeans_centres(points, k, seed, weight=weight, **options))


def initial_centres(points: DataFrame, k: int, seed: int = 42) -> list[tuple[float, float]]:
    """``k`` incidents drawn by a hash of their id, the same for any partitioning."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("violation_id")))
    rows = points.orderBy(draw, "violation_id", "lat", "lon").select("lat", "lon").limit(k)
    return [(r["lat"], r["lon"]) for r in rows.collect()]


def lloyd_step(points: DataFrame, centres: Centres, weight: str | None = None) -> DataFrame:
    """One centre update: the mean of the members, the old centre where there are none.

    The old centres take part in the aggregation as members of weight zero, which keeps
    memberless clusters without a join.
    """
    spark = points.sparkSession
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    members = assign_nearest(points, centres).select(
        F.col("prediction").alias("cluster_id"), "lat", "lon", w.alias("w")
    )
    spine = spark.range(0, len(centres), 1, 1).select(
        F.col("id").cast("int").alias("cluster_id"),
        F.lit(0.0).alias("lat"),
        F.lit(0.0).alias("lon"),
        F.lit(0.0).alias("w"),
    )
    sums = (
        members.unionByName(spine)
        .groupBy("cluster_id")
        .agg(
            F.sum(F.col("lat") * F.col("w")).alias("lat_sum"),
            F.sum(F.col("lon") * F.col("w")).alias("lon_sum"),
            F.sum("w").alias("members"),
        )
    )

    def updated(axis: str, position: int) -> Column:
        old = F.element_at(
            F.array(*(F.lit(float(c[position])) for c in centres)), F.col("cluster_id") + 1
        )
        mean = F.try_divide(F.col(f"{axis}_sum"), F.col("members"))
        return F.coalesce(mean, old).alias(f"center_{axis}")

    return sums.select(
        "cluster_id",
        updated("lat", 0),
        updated("lon", 1),
        F.col("members").cast("bigint").alias("violation_count"),
    )


class LloydResult(NamedTuple):
    """Centres whose assignment is final, the number of passes made, and whether they settled."""

    centres: list[tuple[float, float]]
    iterations: int
    settled: bool


def _settled(old: Centres, new: Centres, rtol: float, atol: float) -> bool:
    return all(
        abs(a - b) <= atol + rtol * abs(b) for o, n in zip(old, new) for a, b in zip(o, n)
    )


def _iterate(
    compact: DataFrame, init: Centres, max_iter: int, rtol: float = 1e-5, atol: float = 1e-5
) -> LloydResult:
    """Lloyd's iterations over a compact table with ``weight``."""
    current = [(float(a), float(b)) for a, b in init]
    used, passes, settled = current, 0, False
    while passes < max_iter and not settled:
        used, passes = current, passes + 1
        rows = lloyd_step(compact, used, weight="weight").collect()
        current = [
            (r["center_lat"], r["center_lon"]) for r in sorted(rows, key=lambda r: r["cluster_id"])
        ]
        settled = _settled(used, current, rtol, atol)
    return LloydResult(used, passes, settled)


def lloyd(
    points: DataFrame,
    init: Centres,
    max_iter: int = 100,
    rtol: float = 1e-5,
    atol: float = 1e-5,
    weight: str | None = None,
) -> LloydResult:
    """Lloyd's algorithm from given start centres (H5).

    Stops when no coordinate moves by more than ``atol + rtol * |coordinate|``. The returned
    centres are those before the last update: they are the ones the final labels refer to.
    """
    compact = cut_lineage(weighted_points(points, weight)).persist()
    try:
        return _iterate(compact, init, max_iter, rtol, atol)
    finally:
        compact.unpersist()


def lloyd_clusters(points: DataFrame, init: Centres, **options) -> DataFrame:
    """Points labelled by Lloyd's algorithm (H5)."""
    return assign_nearest(points, lloyd(points, init, **options).centres)


def cluster_rows(labelled: DataFrame) -> DataFrame:
    """Output columns of the row-level labels; the type only if the input has it."""
    columns = ["violation_id", "lat", "lon", "prediction"]
    if "violation_type" in labelled.columns:
        columns.append("violation_type")
    return labelled.select(*columns)


def cluster_sizes(labelled: DataFrame, weight: str | None = None) -> DataFrame:
    """Incidents per cluster."""
    sizes = labelled.groupBy("prediction").agg(incidents(weight).alias("count"))
    return short_sorted(sizes, "prediction")


def cluster_profile(labelled: DataFrame, weight: str | None = None) -> DataFrame:
    """Mean position, size and most frequent type per cluster.

    Counts per cluster and type come first, so the most frequent type is picked among a few
    rows and a cluster that holds most incidents is never one group of rows.
    """
    per_type = labelled.groupBy("prediction", "violation_type").agg(
        incidents(weight).alias("n"),
        total(F.col("lat"), weight).alias("lat_sum"),
        total(F.col("lon"), weight).alias("lon_sum"),
    )
    size = F.sum("n")
    dominant = F.coalesce(largest("violation_type", F.col("n")), F.lit(C.DEFAULT_DOMINANT))
    profile = per_type.groupBy(F.col("prediction").alias("cluster_id")).agg(
        F.round(F.sum("lat_sum") / size, 6).alias("center_lat"),
        F.round(F.sum("lon_sum") / size, 6).alias("center_lon"),
        size.alias("violation_count"),
        dominant.alias("dominant_violation"),
    )
    return short_sorted(profile, "cluster_id")


def map_centre(labelled: DataFrame, weight: str | None = None) -> DataFrame:
    """Mean latitude and longitude of all points: one row."""
    count = incidents(weight)
    return labelled.agg(
        F.round(total(F.col("lat"), weight) / count, 6).alias("center_lat"),
        F.round(total(F.col("lon"), weight) / count, 6).alias("center_lon"),
    )


def incident_sample(labelled: DataFrame, n: int = 250) -> DataFrame:
    """``n`` labelled incidents drawn by a hash of their id, the same on any layout."""
    return cluster_rows(labelled).orderBy(*_sample_order()).limit(n)


def _sample_order() -> list[Column]:
    return [F.md5(F.col("violation_id")), *map(F.col, ("violation_id", "lat", "lon"))]


def incident_fraction(labelled: DataFrame, fraction: float) -> DataFrame:
    """About this fraction of the labelled incidents: those whose id hashes below a threshold.

    A projection and a filter: no sort and no shuffle. A smaller fraction is a part of a larger one, and
    an incident is in or out whatever other rows there are.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction {fraction} is not between 0 and 1")
    drawn = F.conv(F.substring(F.md5(F.col("violation_id")), 1, 8), 16, 10).cast("bigint")
    return cluster_rows(labelled).where(drawn < F.lit(int(fraction * 2**32)).cast("bigint"))


def incident_sample_per_cluster(labelled: DataFrame, n: int = 50) -> DataFrame:
    """Exactly ``n`` incidents of each cluster (all, if it has fewer), drawn by a hash of their id.

    The least ``n`` hashes of a cluster are found per task first (window group limit), so a cluster that
    holds most incidents sends ``n`` rows a task to the shuffle.
    """
    place = F.row_number().over(Window.partitionBy("prediction").orderBy(*_sample_order()))
    rows = cluster_rows(labelled)
    return rows.withColumn("place", place).where(F.col("place") <= n).select(*rows.columns)

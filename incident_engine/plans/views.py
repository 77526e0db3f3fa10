"""Result views: what dashboards and the JSON API show, each as a DataFrame.

The inputs are the result tables of the operators (day x hour x type counts, hourly risk,
location counts, centroids), not the incidents.
"""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_engine import constants as C
from incident_engine.functions import scoring, text
from incident_engine.functions.geo import HexGrid
from incident_engine.operators import clustering, common, filters, locations, spatial, temporal

Selection = Collection[str] | str | None
NOT_AVAILABLE = "N/A"
#: Queries that can match in the rank of a row, or across a column's end.
RANK_PART = re.compile(r"^#?[0-9]*$|\t")


def hourly(hourly_risk: DataFrame) -> DataFrame:
    """Hourly risk rows in order (V3)."""
    return hourly_risk.orderBy("Hour")


def hotspots(centroids: DataFrame) -> DataFrame:
    """Cluster centroids in order (V2)."""
    return centroids.orderBy("cluster_id")


def corridors(location_counts: DataFrame, n: int = 15) -> DataFrame:
    """Most frequent locations (V4, L2)."""
    return locations.top_locations(location_counts, n)


def hourly_curve(time_type: DataFrame, types: Selection = None, days: Selection = None) -> DataFrame:
    """Count per hour over all 24 hours, 0 where there are none."""
    chosen = filters.by_type_and_day(time_type, types, days)
    curve = common.sum_over_domain(chosen, "Hour", range(24), "count", 0)
    return common.short_sorted(curve, "Hour")


def daily_distribution(
    time_type: DataFrame, types: Selection = None, days: Selection = None
) -> DataFrame:
    """Count per selected weekday, null where there are none."""
    chosen = filters.by_type_and_day(time_type, types, days)
    if days is None or days == filters.ALL:
        domain = C.DAY_ORDER
    else:
        domain = (days,) if isinstance(days, str) else tuple(days)
    result = common.sum_over_domain(chosen, "DayOfWeek", domain, "count", None)
    return common.short_sorted(result, temporal.day_order())


def daily_totals(time_type: DataFrame, types: Selection = None) -> DataFrame:
    """Count per weekday over all seven days for selected types, 0 where there are none."""
    chosen = filters.by_type_and_day(time_type, types)
    result = common.sum_over_domain(chosen, "DayOfWeek", C.DAY_ORDER, "count", 0)
    return common.short_sorted(result, temporal.day_order())


def category_breakdown(
    time_type: DataFrame,
    types: Selection = None,
    days: Selection = None,
    ascending: bool = True,
) -> DataFrame:
    """Count per type, sorted by count."""
    totals = (
        filters.by_type_and_day(time_type, types, days)
        .groupBy("Violation_Type")
        .agg(F.sum("count").alias("count"))
    )
    count = F.asc("count") if ascending else F.desc("count")
    return totals.orderBy(count, "Violation_Type")


def category_list(time_type: DataFrame) -> DataFrame:
    """Types to choose from."""
    return common.distinct_values(time_type, "Violation_Type")


def top_location(location_counts: DataFrame) -> DataFrame:
    """Name of the most frequent location: at most one row (L3)."""
    return locations.top_locations(location_counts, 1).select("Location")


def kpis(
    time_type: DataFrame,
    location_counts: DataFrame,
    types: Selection = None,
    days: Selection = None,
) -> DataFrame:
    """One row of key figures for selected types and days.

    Grouping sets give the totals per type, per hour and overall in one pass. Without any rows
    the figures are 0 and ``N/A``. The top location ignores the selection.
    """
    sets = (
        filters.by_type_and_day(time_type, types, days)
        .withColumn("weight", scoring.severity_weight(F.col("Violation_Type")))
        .groupingSets(
            [("Violation_Type",), ("Hour",), ()], F.col("Violation_Type"), F.col("Hour")
        )
        .agg(
            F.sum("count").alias("n"),
            F.sum(F.col("count") * F.col("weight")).alias("risk"),
            F.grouping_id().alias("level"),
        )
    )
    per_type, per_hour, overall = (F.col("level") == v for v in (1, 2, 3))

    def best(label: str, level: Column) -> Column:
        return F.min_by(label, F.when(level, F.struct(-F.col("n"), F.col(label))))

    def or_zero(value: Column) -> Column:
        return F.coalesce(value, F.lit(0).cast("bigint"))

    figures = sets.agg(
        or_zero(F.max(F.when(overall, F.col("n")))).alias("total_violations"),
        best("Violation_Type", per_type).alias("top_type"),
        or_zero(F.max(F.when(per_type, F.col("n")))).alias("top_type_count"),
        best("Hour", per_hour).alias("peak"),
        or_zero(F.max(F.when(overall, F.col("risk")))).alias("risk_points"),
    )
    return figures.select(
        "total_violations",
        F.coalesce("top_type", F.lit(NOT_AVAILABLE)).alias("top_type"),
        "top_type_count",
        F.coalesce(text.hour_label(F.col("peak")), F.lit(NOT_AVAILABLE)).alias("peak_hour"),
        F.coalesce(top_location(location_counts).scalar(), F.lit(NOT_AVAILABLE)).alias(
            "top_location"
        ),
        "risk_points",
        scoring.ratio_or_zero(F.col("risk_points"), F.col("total_violations")).alias(
            "avg_severity"
        ),
    )


def anomaly_audit(hourly_risk: DataFrame) -> DataFrame:
    """Hourly audit table with labels and recommended actions."""
    level = text.first_present(F.col("anomaly_level"), default=C.NORMAL)
    z = F.coalesce(F.col("z_score"), F.lit(0.0))
    return hourly_risk.orderBy("Hour").select(
        text.hour_label(F.col("Hour")).alias("hour_label"),
        "violation_count",
        F.concat(F.col("total_risk_score").cast("string"), F.lit(" pts")).alias("risk_label"),
        text.signed_two_decimals(z).alias("z_label"),
        level.alias("anomaly_level"),
        text.first_present(F.col("primary_violation"), default=C.DEFAULT_PRIMARY).alias(
            "primary_violation"
        ),
        scoring.patrol_action(level).alias("action"),
    )


def corridor_table(location_counts: DataFrame, query: str = "", n: int = 10) -> DataFrame:
    """Top locations with rank, density share and position.

    With a ``query`` the first ``n`` rows of the whole table whose rank, place or count contain it,
    under their ranks in the whole table. Unless the query may be part of a rank itself (digits, with or
    without ``#``) or of the gap after one, the rows are found first and only they are ranked.
    """
    keys = ("count", "Location")
    if query and not RANK_PART.search(query):
        found = filters.search_rows(location_counts, query, "Location", "count")
        top = common.ranks_of(locations.top_locations(found, n), location_counts, n, *keys)
    elif query:
        rows = common.ranked_all(location_counts, *keys)
        rows = rows.withColumn("rank_label", F.concat(F.lit("#"), F.col("rank").cast("string")))
        found = filters.search_rows(rows, query, "rank_label", "Location", "count")
        top = found.orderBy("rank").limit(n)
    else:
        top = common.ranked(locations.top_locations(location_counts, n), *keys)
    return top.select(
        F.concat(F.lit("#"), F.col("rank").cast("string")).alias("rank_label"),
        "Location",
        "count",
        scoring.density_share(F.col("count")).alias("density_share"),
        text.leading_number(F.get(F.split("Location", ","), F.lit(0))).alias("lat"),
        text.leading_number(F.get(F.split("Location", ","), F.lit(1))).alias("lon"),
    )


def critical_alert(hourly_risk: DataFrame) -> DataFrame:
    """One row with the critical hours as text, no row when there are none."""
    hours = F.array_sort(F.collect_list("Hour"))
    labels = F.array_join(F.transform(hours, text.hour_label), ", ")
    return (
        filters.critical_hours(hourly_risk)
        .agg(labels.alias("spike_hours"), F.count(F.lit(1)).alias("n_hours"))
        .where(F.col("n_hours") > 0)
    )


def intensity_matrix(matrix: DataFrame) -> DataFrame:
    """Hour x type table in wide form, one column per hour, 0 where there are none."""
    wide = matrix.groupBy("violation_type").pivot("Hour", list(range(24))).agg(
        F.sum("violation_count")
    )
    hours = [F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"h{h:02d}") for h in range(24)]
    return wide.select("violation_type", *hours).orderBy("violation_type")


def centroid_table(centroids: DataFrame) -> DataFrame:
    """Centroids under reader-friendly titles."""
    return centroids.withColumnsRenamed(C.CENTROID_TITLES).orderBy("Cluster ID")


def map_points(labelled: DataFrame) -> DataFrame:
    """Clustered points with the colour of their cluster, both as RGBA and hex."""
    points = spatial.numeric_coordinates(clustering.cluster_rows(labelled))
    coloured = common.map_column(points, "prediction", C.CLUSTER_RGBA, "color")
    return common.map_column(coloured, "prediction", C.CLUSTER_HEX, "color_hex", C.DEFAULT_HEX)


def map_hexagons(labelled: DataFrame, radius_m: float = 140.0) -> DataFrame:
    """Hexagon density of the clustered points."""
    return spatial.hexbin_density(labelled, HexGrid(radius_m))


def map_view(labelled: DataFrame, mode: str = "clusters") -> DataFrame:
    """Layer shown for a map mode: ``clusters`` or ``hexagons``."""
    if mode == "clusters":
        return map_points(labelled)
    if mode == "hexagons":
        return map_hexagons(labelled)
    raise ValueError(f"unknown map mode {mode!r}; expected 'clusters' or 'hexagons'")


def _ordered_rows(df: DataFrame, *order: Column, columns: list[str]) -> DataFrame:
    """A short table as one array of structs, sorted by ``order``."""
    row = F.struct(*(o.alias(f"k{i}") for i, o in enumerate(order)), F.struct(*columns).alias("row"))
    return df.agg(
        F.transform(F.array_sort(F.collect_list(row)), lambda x: x["row"]).alias("rows")
    )


def summary(
    hourly_risk: DataFrame, location_counts: DataFrame, centroids: DataFrame, n: int = 10
) -> DataFrame:
    """One row: total, peak hour, critical hours, top locations and centroids.

    The three inputs are short result tables; each is folded by a scalar subquery.
    """
    top = locations.top_locations(location_counts, n)
    top_rows = _ordered_rows(
        top, -F.col("count"), F.col("Location"), columns=["Location", "count"]
    )
    centroid_rows = _ordered_rows(centroids, F.col("cluster_id"), columns=centroids.columns)
    peak = F.min_by("Hour", F.struct(-F.col("violation_count"), F.col("Hour")))
    critical = F.collect_list(F.when(F.col("anomaly_level") == C.CRITICAL, F.col("Hour")))
    return hourly_risk.agg(
        F.coalesce(F.sum("violation_count"), F.lit(0).cast("bigint")).alias("total_violations"),
        F.coalesce(text.hour_label(peak), F.lit(NOT_AVAILABLE)).alias("rush_hour_spike"),
        F.array_sort(critical).alias("critical_spike_hours"),
    ).select(
        "*",
        top_rows.scalar().alias("top_locations"),
        centroid_rows.scalar().alias("clusters"),
    )

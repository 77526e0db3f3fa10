"""Named queries over the ``events`` table of a data directory.

Raw incidents are derived from all rows of ``events`` and every query runs over all of them.
The derived rows are landed as a parquet table in the shared folder once per session, as raw
files would lie there, so that each query scans only the columns it needs and pushes its null
filters into the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_engine import constants as C
from incident_engine.functions import geo, text, timeparts
from incident_engine.operators import (
    cleaning,
    clustering,
    common,
    filters,
    locations,
    lookups,
    nearest,
    risk,
    spatial,
    temporal,
)
from incident_engine.plans import daily, views
from incident_engine.scratch import has_shared_dir, scratch_path
from incident_engine.sources import files, sinks, synth
from incident_engine.sources.adapters import violations_from_events
from incident_engine.streaming import surges

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL side.
SYNTH_ANCHOR = dt.date(2026, 1, 1)
SYNTH_SEED = 42
SAMPLE_SIZE = 250
LLOYD_START = ((40.70, -74.02), (40.72, -74.00), (40.74, -73.99), (40.76, -73.97), (40.80, -73.95))
CHOSEN_TYPES = ("DUI", "Speeding", "Red Light Violation")
CHOSEN_DAYS = ("Monday", "Friday", "Sunday")
SEARCH = "40.75"
STREAM_DELAY_HOURS = 1
SAMPLE_FRACTION = 0.05
SAMPLE_PER_CLUSTER = 40
#: Cells per degree of the centre table, and where in its cell a centre lies.
CENTRE_CELLS, CENTRE_PLACE = 500, 0.3


# ---- shared inputs ---------------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_parquet(spark, f"{sf_dir}/events.parquet")


_landed: dict[tuple[str, str], str] = {}


def raw_path(spark: SparkSession, sf_dir: str) -> str:
    """Where the raw incidents of a data directory lie; writes them on first use."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        path = scratch_path(spark, "raw_incidents")
        sinks.write_parquet(violations_from_events(events(spark, sf_dir)), path)
        _landed[key] = path
    return _landed[key]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw incidents of a data directory; derived on the fly where there is no shared folder."""
    if not has_shared_dir(spark):
        return violations_from_events(events(spark, sf_dir))
    return spark.read.schema(C.RAW_SCHEMA).parquet(raw_path(spark, sf_dir))


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(raw(spark, sf_dir))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.extract_coordinates(incidents(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points labelled by the nearest of the five fixed hotspots."""
    return clustering.assign_nearest(points(spark, sf_dir), C.HOTSPOTS)


def time_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day x hour x type counts without an order, as the input of other operators."""
    return temporal.time_type_counts(raw(spark, sf_dir))


def place_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locations.location_counts(raw(spark, sf_dir))


def hourly_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.hourly_risk(incidents(spark, sf_dir))


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_profile(labelled(spark, sf_dir))


def over(source: Query, operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """Query that applies an operator to a shared input."""
    return lambda spark, sf_dir: operator(source(spark, sf_dir), *args, **kwargs)


def centre_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A centre in each small cell that holds incidents, numbered by its cell."""
    cells = points(spark, sf_dir).select(
        *(geo.grid_index(F.col(c), CENTRE_CELLS).alias(x) for c, x in (("lat", "x"), ("lon", "y")))
    )
    place = [((F.col(c) + F.lit(CENTRE_PLACE)) / F.lit(float(CENTRE_CELLS))) for c in ("x", "y")]
    number = ((F.col("x") - 20_000) * 10_000 + F.col("y") + 40_000).cast("int")
    return cells.distinct().select(
        number.alias("cluster_id"), place[0].alias("center_lat"), place[1].alias("center_lon")
    )


def severity_table(spark: SparkSession) -> DataFrame:
    """Severity points per type as a dimension table."""
    return spark.createDataFrame(list(C.SEVERITY_WEIGHTS.items()), "kind string, points int")


# ---- queries that need more than one operator ------------------------------------------------


def nearest_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest of a table of centres for every incident."""
    found = nearest.nearest_in_table(points(spark, sf_dir), centre_table(spark, sf_dir))
    return found.select("violation_id", "lat", "lon", "prediction", F.round("distance", 9).alias("distance"))


def severity_from_table(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Severity of every incident, looked up by its trimmed type in a table."""
    keys = {"kind": text.strip(F.col("violation_type"))}
    found = lookups.lookup_table(
        incidents(spark, sf_dir), severity_table(spark), keys, {"points": C.DEFAULT_SEVERITY}, **options
    )
    return found.select("violation_id", "violation_type", F.col("points").alias("severity_score"))


def place_profile_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every incident with the total and risk of its place: a dimension that is as large as there are places."""
    rows = incidents(spark, sf_dir)
    totals = risk.location_totals(rows).select("location", "total_violations", "total_risk_score")
    found = lookups.lookup_table(
        rows.select("violation_id", F.col("location").alias("place")),
        totals,
        {"location": F.col("place")},
        {"total_violations": 0, "total_risk_score": 0},
        broadcast_bytes=0,
    )
    return found.select("violation_id", F.col("place").alias("location"), "total_violations", "total_risk_score")


def cluster_colours_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every clustered incident with the colour of its cluster from a table that lacks the last cluster."""
    colours = spark.createDataFrame(list(C.CLUSTER_HEX.items())[:-1], "cluster int, hex string")
    found = lookups.lookup_table(
        clustering.cluster_rows(labelled(spark, sf_dir)), colours, {"cluster": F.col("prediction")}, {"hex": C.DEFAULT_HEX}
    )
    return found.select("violation_id", "prediction", "hex")


def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vector of every incident, its two entries as columns."""
    return clustering.feature_vectors(points(spark, sf_dir)).select(
        "violation_id", *(F.get(vector_to_array("features"), F.lit(i)).alias(f"f{i}") for i in range(2))
    )


def type_hour_z_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume of each type in each hour against the type's other hours."""
    counts = risk.hour_type_counts(incidents(spark, sf_dir)).where(F.col("violation_type").isNotNull())
    return risk.z_scores(counts, "n", ["violation_type"])


def place_type_z_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume of each type at each place against the place's other types."""
    counts = incidents(spark, sf_dir).groupBy("location", "violation_type").agg(F.count(F.lit(1)).alias("n"))
    return risk.z_scores(counts.where(F.col("violation_type").isNotNull()), "n", ["location"])


def place_z_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume of each place against all places."""
    return risk.z_scores(place_counts(spark, sf_dir), "count")


def completed_time_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day x hour x type counts with a row for every combination, 0 where there are none."""
    table = filters.by_type_and_day(time_type(spark, sf_dir), None, CHOSEN_DAYS)
    kinds = raw(spark, sf_dir).select("Violation_Type").where(F.col("Violation_Type").isNotNull()).distinct()
    domain = common.product(kinds, {"DayOfWeek": C.DAY_ORDER, "Hour": range(24)})
    return common.complete(table, domain, {"count": 0})


def bundle_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result that has no rows of its own, taken from a stored bundle of results."""
    path = scratch_path(spark, "bundle")
    matrix = risk.time_type_matrix(incidents(spark, sf_dir))
    top = locations.top_locations(place_counts(spark, sf_dir))
    sinks.write_bundle(path, {"time_type_matrix": matrix, "top_locations": top})
    schemas = {"time_type_matrix": C.TIME_TYPE_MATRIX_SCHEMA, "top_locations": C.LOCATION_COUNT_SCHEMA, "none": "x int"}
    members = files.read_bundle_members(spark, path, schemas)
    return common.coalesce_frames(matrix.where("false"), members["time_type_matrix"])


def underscore_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows under headers with blanks, scanned back with underscores for them."""
    path = scratch_path(spark, "blank_headers_csv")
    rows = raw(spark, sf_dir)
    sinks.write_csv(rows.toDF(*(f" {c.replace('_', ' ')} " for c in rows.columns)), path)
    return files.read_incidents_csv(spark, path, underscore=True)


def ensured_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents whose timestamps are still text, parsed where they are needed."""
    rows = raw(spark, sf_dir).select("Violation_Id", F.col("Timestamp").alias("timestamp"))
    return cleaning.ensure_timestamp(rows).select("Violation_Id", "timestamp_parsed")


def daily_location_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location risk after two daily runs: all days but the last at once, then the last."""
    given = events(spark, sf_dir)
    rows = violations_from_events(given, F.col("ts").cast("date").alias("day"))
    *earlier, last = sorted(r["day"] for r in given.select(F.col("ts").cast("date").alias("day")).distinct().collect())
    layout = daily.DailyLayout(scratch_path(spark, "daily"))
    for days in (earlier, [last]):
        if days:
            daily.stage_days(rows, layout, days)
    counts = daily.place_counts(spark, layout).where("n_accepted > 0")
    return risk.rank_location_risk(risk.location_totals(counts, weight="n_accepted"))


def kpi_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key figures as shown, with commas between thousands."""
    figures = kpis(spark, sf_dir)
    return figures.select(*(text.thousands(F.col(c)).alias(c) for c in ("total_violations", "risk_points")))


def severity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.with_severity(incidents(spark, sf_dir)).select(
        "violation_id", "violation_type", "severity_score"
    )


def extract_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).select("violation_id", "lat", "lon")


def volume_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = risk.volume_stats(hourly_risk(spark, sf_dir))
    return stats.select(*(F.round(c, 6).alias(c) for c in stats.columns))


def critical_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.critical_hours(hourly_risk(spark, sf_dir)).select("Hour", "z_score")


def lloyd_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = clustering.lloyd_step(points(spark, sf_dir), LLOYD_START)
    return step.select(
        "cluster_id",
        F.round("center_lat", 6).alias("center_lat"),
        F.round("center_lon", 6).alias("center_lon"),
        "violation_count",
    )


def lloyd_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    geo = points(spark, sf_dir)
    found = clustering.lloyd(geo, LLOYD_START)
    rows = clustering.cluster_rows(clustering.assign_nearest(geo, found.centres))
    return rows.withColumn("settled", F.lit(found.settled))


def kmeans_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_rows(clustering.cluster_hotspots(points(spark, sf_dir)))


def kmeans_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_profile(clustering.cluster_hotspots(points(spark, sf_dir)))


def lloyd_sampled_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    geo = points(spark, sf_dir)
    start = clustering.initial_centres(geo, 5)
    return clustering.cluster_profile(clustering.lloyd_clusters(geo, start))


def map_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = views.map_view(labelled(spark, sf_dir), "clusters")
    return shown.withColumn("color", F.concat_ws(",", F.col("color").cast("array<string>")))


def kpis(spark: SparkSession, sf_dir: str, types=None, days=None) -> DataFrame:
    return views.kpis(time_type(spark, sf_dir), place_counts(spark, sf_dir), types, days)


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-row summary with its arrays flattened to text."""
    row = views.summary(
        hourly_risk(spark, sf_dir), place_counts(spark, sf_dir), centroids(spark, sf_dir)
    )

    def flat(column: str, *fields: str) -> Column:
        pieces = F.transform(
            column, lambda x: F.concat_ws("=", *(x[f].cast("string") for f in fields))
        )
        return F.array_join(pieces, ";").alias(column)

    return row.select(
        "total_violations",
        "rush_hour_spike",
        F.array_join(F.col("critical_spike_hours").cast("array<string>"), ",").alias(
            "critical_spike_hours"
        ),
        flat("top_locations", "Location", "count"),
        flat("clusters", "cluster_id", "violation_count", "dominant_violation"),
    )


def csv_scan_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows written as CSV, scanned back by header and cleaned."""
    path = scratch_path(spark, "raw_csv")
    sinks.write_csv(raw(spark, sf_dir), path)
    return cleaning.clean(files.read_incidents_csv(spark, path))


def result_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result written as CSV parts and read back with its schema."""
    path = scratch_path(spark, "hourly_csv")
    sinks.write_csv(hourly_risk(spark, sf_dir), path)
    return files.read_result_csv(spark, path, C.HOURLY_RISK_SCHEMA)


def result_rows_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result written as CSV parts and read back as text, with a missing one as fallback."""
    path = scratch_path(spark, "matrix_csv")
    sinks.write_csv(risk.time_type_matrix(incidents(spark, sf_dir)), path)
    absent = files.read_result_rows(spark, path + "-absent", C.TIME_TYPE_MATRIX_SCHEMA)
    stored = files.read_result_rows(spark, path, C.TIME_TYPE_MATRIX_SCHEMA)
    return common.coalesce_frames(absent, stored)


def parquet_scan_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows written as parquet and scanned back."""
    path = scratch_path(spark, "clean_parquet")
    sinks.write_parquet(incidents(spark, sf_dir), path)
    return files.read_parquet(spark, path)


def export_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filtered day x hour x type report as exported to CSV."""
    path = scratch_path(spark, "report_csv")
    rows = filters.by_type_and_day(time_type(spark, sf_dir), CHOSEN_TYPES, CHOSEN_DAYS)
    sinks.export_report(rows, path, [temporal.day_order(), "Hour", "Violation_Type"])
    return files.read_result_csv(spark, path, C.TIME_TYPE_SCHEMA)


def corridors_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.json_rows(views.corridors(place_counts(spark, sf_dir)), as_text=True)


def synthesize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic incident per event."""
    return synth.synthesize_from_ids(events(spark, sf_dir), "event_id", SYNTH_ANCHOR, SYNTH_SEED)


def streaming_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files streamed into clock-hour counts; hours that the watermark has passed."""
    target = scratch_path(spark, "stream_counts")
    stream = surges.stream_incidents(spark, raw_path(spark, sf_dir), "parquet")
    counts = surges.hourly_window_counts(stream, f"{STREAM_DELAY_HOURS} hours")
    job = (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", scratch_path(spark, "stream_state"))
        .trigger(availableNow=True)
        .start(target)
    )
    job.awaitTermination()
    return spark.read.schema(counts.schema).parquet(target)


def streaming_surges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files streamed into the hourly risk table as it stands after the last file."""
    target = scratch_path(spark, "stream_risk")
    stream = surges.stream_incidents(spark, raw_path(spark, sf_dir), "parquet")
    job = (
        surges.surge_alerts(stream, lambda table, batch: sinks.write_parquet(table, target))
        .option("checkpointLocation", scratch_path(spark, "stream_state"))
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return files.read_parquet(spark, target)


def weekday_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finest time counts of the cleaned rows, with names."""
    return temporal.weekday_hour_type_counts(incidents(spark, sf_dir)).withColumn(
        "DayOfWeek", timeparts.weekday_name(F.col("weekday"))
    )


QUERIES: dict[str, Query] = {
    # sources and cleaning
    "raw_violations": raw,
    "clean": incidents,
    "raw_reject_counts": over(raw, cleaning.reject_counts),
    "csv_scan_clean": csv_scan_clean,
    "parquet_scan_clean": parquet_scan_clean,
    "result_csv_scan": result_csv_scan,
    "result_rows_scan": result_rows_scan,
    "bundle_fallback": bundle_fallback,
    "underscore_header_scan": underscore_header_scan,
    "ensured_timestamps": ensured_timestamps,
    "synthesize": synthesize,
    # time
    "count_by_hour": over(incidents, temporal.count_by, "hour_of_day"),
    "count_by_day_of_week": over(incidents, temporal.count_by, "day_of_week"),
    "count_by_month": over(incidents, temporal.count_by, "month"),
    "count_by_year": over(incidents, temporal.count_by, "year"),
    "time_type_aggregation": over(raw, temporal.time_type_aggregation),
    "weekday_hour_type_counts": weekday_hours,
    # places
    "violations_per_location": over(raw, locations.violations_per_location),
    "top_locations": over(place_counts, locations.top_locations),
    "corridors_15": over(place_counts, views.corridors),
    "corridors_json": corridors_json,
    "corridor_table": over(place_counts, views.corridor_table),
    "corridor_search": over(place_counts, views.corridor_table, SEARCH),
    # space
    "extract_coordinates": extract_coordinates,
    "grid_counts": over(points, spatial.grid_counts),
    "top_grids": over(over(points, spatial.grid_counts), spatial.top_grids),
    "hexbin_density": over(points, spatial.hexbin_density),
    # clusters
    "nearest_centroid": over(labelled, clustering.cluster_rows),
    "cluster_sizes": over(labelled, clustering.cluster_sizes),
    "cluster_profile": centroids,
    "centroid_table": over(centroids, views.centroid_table),
    "hotspots": over(centroids, views.hotspots),
    "lloyd_step": lloyd_step,
    "lloyd_clusters": lloyd_clusters,
    "lloyd_sampled_centroids": lloyd_sampled_centroids,
    "kmeans_clusters": kmeans_clusters,
    "kmeans_centroids": kmeans_centroids,
    "incident_sample": over(labelled, clustering.incident_sample, SAMPLE_SIZE),
    "map_points": map_points,
    "map_hexagons": over(labelled, views.map_view, "hexagons"),
    "map_center": over(labelled, clustering.map_centre),
    "nearest_from_table": nearest_from_table,
    "feature_vectors": feature_vectors,
    "incident_fraction": over(labelled, clustering.incident_fraction, SAMPLE_FRACTION),
    "incident_sample_per_cluster": over(labelled, clustering.incident_sample_per_cluster, SAMPLE_PER_CLUSTER),
    "cluster_colours_from_table": cluster_colours_from_table,
    # risk
    "severity_lookup": severity_lookup,
    "severity_from_table": severity_from_table,
    "place_profile_lookup": place_profile_lookup,
    "type_hour_z_scores": type_hour_z_scores,
    "place_type_z_scores": place_type_z_scores,
    "place_z_scores": place_z_scores,
    "hourly_risk_anomaly": hourly_risk,
    "hourly_volume_stats": volume_stats,
    "primary_violation_per_hour": over(incidents, risk.primary_violation_per_hour),
    "top_risk_hours": over(hourly_risk, risk.top_risk_hours),
    "critical_hours": critical_hours,
    "location_risk": over(incidents, risk.location_risk),
    "time_type_matrix": over(incidents, risk.time_type_matrix),
    "intensity_matrix_wide": over(
        over(incidents, risk.time_type_matrix), views.intensity_matrix
    ),
    # views
    "filtered_time_type": over(time_type, filters.by_type_and_day, CHOSEN_TYPES, CHOSEN_DAYS),
    "single_choice_time_type": over(time_type, filters.by_type_and_day, "DUI", "Friday"),
    "kpis": kpis,
    "kpis_filtered": partial(kpis, types=CHOSEN_TYPES, days=CHOSEN_DAYS),
    "kpi_labels": kpi_labels,
    "daily_location_risk": daily_location_risk,
    "hourly_view": over(hourly_risk, views.hourly),
    "completed_time_type": completed_time_type,
    "hourly_curve": over(time_type, views.hourly_curve, CHOSEN_TYPES, CHOSEN_DAYS),
    "daily_distribution": over(time_type, views.daily_distribution, CHOSEN_TYPES, CHOSEN_DAYS),
    "daily_totals": over(time_type, views.daily_totals, "DUI"),
    "category_breakdown": over(time_type, views.category_breakdown, None, CHOSEN_DAYS),
    "category_list": over(time_type, views.category_list),
    "export_filtered": export_filtered,
    "critical_alert": over(hourly_risk, views.critical_alert),
    "anomaly_audit": over(hourly_risk, views.anomaly_audit),
    "summary": summary,
    # streams
    "streaming_hourly_counts": streaming_hourly_counts,
    "streaming_surges": streaming_surges,
}

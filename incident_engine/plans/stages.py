"""The batch job: raw incidents in, all result tables out.

How the passes are arranged:

* The raw rows are parsed once and stored as parquet, split by whether cleaning accepts them.
  Everything after reads columns of that table, so text parsing is never repeated.
* One pass over (timestamp, type) gives a table of at most 336 rows per type, from which the
  per-hour, day x hour x type, hourly risk and hour x type results are summed.
* One pass over (location, type) gives counts per distinct location and type, and from these
  totals per location. Both are stored, and location ranking, location risk, grid, clustering
  and centroids read them instead of the incidents: the two rankings are sorts without another
  aggregation, and coordinates are parsed once per distinct location.
* The row-level cluster labels are a projection over the accepted rows: no shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_engine import constants as C
from incident_engine.operators import cleaning, clustering, locations, risk, spatial, temporal
from incident_engine.sources import files, sinks, synth

Progress = Callable[[int, int, str], None]


@dataclass(frozen=True)
class Layout:
    """Where the job puts its tables under one folder."""

    root: str

    def at(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    @property
    def synthetic(self) -> str:
        return self.at("input", "synthetic_csv")

    @property
    def staged(self) -> str:
        return self.at("incidents_parquet")

    @property
    def cleaned(self) -> str:
        """Accepted rows: a plain parquet directory with the four cleaned columns."""
        return self.at("incidents_parquet", "accepted=true")

    def aggregation(self, name: str) -> str:
        return self.at("aggregations", name)

    def output(self, name: str) -> str:
        return self.at("output", name)


def stage_incidents(raw: DataFrame, layout: Layout) -> DataFrame:
    """Parse raw rows once into parquet partitioned by acceptance, and read them back."""
    sinks.write_parquet(cleaning.with_acceptance(raw), layout.staged, "accepted")
    return raw.sparkSession.read.schema(f"{C.CLEAN_SCHEMA}, accepted boolean").parquet(
        layout.staged
    )


def time_counts(staged: DataFrame, layout: Layout) -> DataFrame:
    """Rows per acceptance, weekday, hour and type, stored as a table."""
    path = layout.aggregation("time_type_counts")
    counts = temporal.weekday_hour_type_counts(staged, extra=("accepted",))
    sinks.write_parquet(counts, path)
    return staged.sparkSession.read.schema(counts.schema).parquet(path)


def location_type_counts(staged: DataFrame, layout: Layout) -> DataFrame:
    """Rows per location and type, all and accepted ones, stored as a table."""
    path = layout.aggregation("location_type_counts")
    counts = (
        staged.where(F.col("location").isNotNull())
        .groupBy("location", "violation_type")
        .agg(
            F.count(F.lit(1)).alias("n_raw"),
            F.count_if("accepted").alias("n_accepted"),
        )
    )
    sinks.write_parquet(counts, path)
    return staged.sparkSession.read.schema(counts.schema).parquet(path)


def location_totals(counts: DataFrame, layout: Layout) -> DataFrame:
    """All raw rows and the risk totals of accepted rows per location, stored as a table."""
    path = layout.aggregation("location_totals")
    raw_rows = F.sum("n_raw").alias("n_raw")
    totals = risk.location_totals(counts, weight="n_accepted", extra=(raw_rows,))
    sinks.write_parquet(totals, path)
    return counts.sparkSession.read.schema(totals.schema).parquet(path)


def write_time_results(counts: DataFrame, layout: Layout) -> None:
    """Per-hour counts of accepted rows."""
    per_hour = (
        counts.where("accepted")
        .groupBy(F.col("Hour").alias("hour_of_day"))
        .agg(F.sum("n").alias("count"))
    )
    sinks.write_parquet(
        per_hour.repartition(1).sortWithinPartitions("hour_of_day"), layout.aggregation("per_hour")
    )


def write_time_type_results(counts: DataFrame, layout: Layout) -> None:
    """Day x hour x type counts of all raw rows."""
    table = temporal.named_time_type(counts)
    order = [temporal.day_order(), "Hour", "Violation_Type"]
    sinks.write_csv(table, layout.output("time_type_aggregation.csv"), order)


def write_location_results(totals: DataFrame, layout: Layout) -> None:
    """Location ranking of all raw rows and its head."""
    counts = totals.select(F.col("location").alias("Location"), F.col("n_raw").alias("count"))
    sinks.write_csv(
        locations.rank_locations(counts), layout.output("violations_per_location_csv")
    )
    sinks.write_csv(
        locations.top_locations(counts),
        layout.output("top_locations_csv"),
        [F.desc("count"), "Location"],
    )


def write_place_results(
    counts: DataFrame, totals: DataFrame, layout: Layout, k: int, seed: int
) -> clustering.Places:
    """Grid counts and centroids of accepted rows, from counts per place; gives the centres."""
    places = spatial.extract_coordinates(totals.where("total_violations > 0"))
    sinks.write_csv(
        spatial.grid_counts(places, weight="total_violations"), layout.output("grid_counts_csv")
    )
    n = places.agg(F.coalesce(F.sum("total_violations"), F.lit(0))).first()[0]
    if n >= k:
        centres = clustering.kmeans_centres(places, k, seed, weight="total_violations")
    else:
        centres = [(0.0, 0.0)]
    typed_places = spatial.extract_coordinates(counts.where("n_accepted > 0"))
    profile = clustering.cluster_profile(
        clustering.assign_nearest(typed_places, centres), weight="n_accepted"
    )
    sinks.write_csv(profile, layout.output("cluster_centroids_csv"), ["cluster_id"])
    return centres


def write_hotspot_results(
    staged: DataFrame, counts: DataFrame, totals: DataFrame, layout: Layout, k: int, seed: int
) -> None:
    """Grid counts, k-means labels and centroids of accepted rows."""
    centres = write_place_results(counts, totals, layout, k, seed)
    labelled = clustering.assign_nearest(spatial.extract_coordinates(staged.where("accepted")), centres)
    sinks.write_csv(clustering.cluster_rows(labelled), layout.output("hotspot_clusters_csv"))


def write_risk_results(time: DataFrame, totals: DataFrame, layout: Layout) -> None:
    """Hourly risk, location risk and hour x type matrix of accepted rows."""
    per_hour = time.where("accepted").groupBy("Hour", "violation_type").agg(F.sum("n").alias("n"))
    sinks.write_csv(
        risk.hourly_risk_from_counts(per_hour), layout.output("hourly_risk_anomaly_csv"), ["Hour"]
    )
    sinks.write_csv(
        risk.rank_location_risk(totals.where("total_violations > 0")),
        layout.output("location_risk_csv"),
    )
    sinks.write_csv(
        risk.time_type_matrix_from_counts(per_hour),
        layout.output("time_type_matrix_csv"),
        ["Hour", "violation_type"],
    )


def run_pipeline(
    spark: SparkSession,
    input_path: str | None,
    output_path: str,
    generate: int | None = None,
    anchor: dt.date | None = None,
    on_progress: Progress | None = None,
    k: int = 5,
    seed: int = 42,
) -> Layout:
    """Run all stages in one session.

    ``input_path`` is a CSV file or directory. With ``generate`` that many synthetic rows from
    ``anchor`` on are written and used instead. ``on_progress`` gets (step, steps, message).
    """
    layout = Layout(output_path)
    steps = 6 + (generate is not None)
    done = 0

    def report(message: str) -> None:
        nonlocal done
        done += 1
        if on_progress is not None:
            on_progress(done, steps, message)

    if generate is not None:
        report("generate synthetic incidents")
        sinks.write_csv(synth.synthesize(spark, generate, anchor, seed), layout.synthetic)
        input_path = layout.synthetic
    if input_path is None:
        raise ValueError("give an input path or a number of rows to generate")

    report("parse and clean raw incidents")
    staged = stage_incidents(files.read_incidents_csv(spark, input_path), layout)

    report("count incidents per hour")
    time = time_counts(staged, layout)
    write_time_results(time, layout)

    report("count incidents per weekday, hour and type")
    write_time_type_results(time, layout)

    report("rank locations")
    places = location_type_counts(staged, layout)
    totals = location_totals(places, layout)
    write_location_results(totals, layout)

    report("bin and cluster coordinates")
    write_hotspot_results(staged, places, totals, layout, k, seed)

    report("score risk and surges")
    write_risk_results(time, totals, layout)
    return layout

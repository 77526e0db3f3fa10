"""The batch job in daily runs: each reads its own days only and equals one run over all of them.

Raw rows bear the ``day`` they were delivered on. A run stages the rows of its days, partitioned by day, and
counts them per day; writing replaces exactly these days (dynamic partition overwrite), so a day can be
delivered again, and a run that was cut short is simply repeated. Counts of all days add up, so every result
is made from the stored counts, which hold at most a few rows per place and type for a day, and no earlier
incident is read again. Row labels follow from the place: they are a view, not a table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_engine import constants as C
from incident_engine.operators import cleaning, clustering, spatial, temporal
from incident_engine.operators.lookups import lookup_table
from incident_engine.plans import stages
from incident_engine.scratch import cut_lineage
from incident_engine.sources import sinks

STAGED_SCHEMA = f"{C.CLEAN_SCHEMA}, accepted boolean, day date"
TIME_SCHEMA = "accepted boolean, weekday int, Hour int, violation_type string, n bigint, day date"
PLACE_SCHEMA = "location string, violation_type string, n_raw bigint, n_accepted bigint, day date"


@dataclass(frozen=True)
class DailyLayout(stages.Layout):
    """Where the daily job keeps its tables under one folder."""

    @property
    def days(self) -> str:
        return self.at("incidents_by_day")

    @property
    def time_by_day(self) -> str:
        return self.aggregation("time_type_counts_by_day")

    @property
    def places_by_day(self) -> str:
        return self.aggregation("location_type_counts_by_day")

    @property
    def place_labels(self) -> str:
        return self.aggregation("place_labels")


def _of_days(df: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """Rows of some days; of a table partitioned by day no others are read."""
    return df.where(F.col("day").isin(*days))


def stage_days(raw: DataFrame, layout: DailyLayout, days: Sequence[dt.date]) -> None:
    """Stage and count the rows of ``raw`` (with a date column ``day``) of some days, replacing these days.

    A day without rows is an error, as its earlier delivery would stay in place.
    """
    spark, fresh = raw.sparkSession, _of_days(raw, days)
    there = {r["day"] for r in fresh.select("day").distinct().collect()}
    if there != set(days):
        raise ValueError(f"no rows of {sorted(set(days) - there)}")
    typed = cleaning.with_acceptance(fresh, extra=("day",))
    sinks.replace_partitions(typed, layout.days, "day")
    staged = _of_days(spark.read.schema(STAGED_SCHEMA).parquet(layout.days), days)
    times = temporal.weekday_hour_type_counts(staged, extra=("day", "accepted"))
    sinks.replace_partitions(times, layout.time_by_day, "day")
    places = (
        staged.where(F.col("location").isNotNull())
        .groupBy("day", "location", "violation_type")
        .agg(F.count(F.lit(1)).alias("n_raw"), F.count_if("accepted").alias("n_accepted"))
    )
    sinks.replace_partitions(places, layout.places_by_day, "day")


def time_counts(spark: SparkSession, layout: DailyLayout) -> DataFrame:
    """Rows per acceptance, weekday, hour and type over all days staged so far."""
    by_day = spark.read.schema(TIME_SCHEMA).parquet(layout.time_by_day)
    return by_day.groupBy("accepted", "weekday", "Hour", "violation_type").agg(F.sum("n").alias("n"))


def place_counts(spark: SparkSession, layout: DailyLayout) -> DataFrame:
    """Rows per location and type, all and accepted ones, over all days staged so far."""
    by_day = spark.read.schema(PLACE_SCHEMA).parquet(layout.places_by_day)
    return by_day.groupBy("location", "violation_type").agg(
        F.sum("n_raw").alias("n_raw"), F.sum("n_accepted").alias("n_accepted")
    )


def write_results(spark: SparkSession, layout: DailyLayout, k: int = 5, seed: int = 42) -> None:
    """All results of the batch job but the row labels, from stored counts, and the label of every place."""
    times = cut_lineage(time_counts(spark, layout))
    stages.write_time_results(times, layout)
    stages.write_time_type_results(times, layout)
    places = cut_lineage(place_counts(spark, layout))
    totals = stages.location_totals(places, layout)
    stages.write_location_results(totals, layout)
    centres = stages.write_place_results(places, totals, layout, k, seed)
    points = spatial.extract_coordinates(totals.where("total_violations > 0"))
    labels = clustering.assign_nearest(points, centres).select("location", "lat", "lon", "prediction")
    sinks.write_parquet(labels, layout.place_labels)
    stages.write_risk_results(times, totals, layout)


def run_days(
    raw: DataFrame, output_path: str, days: Sequence[dt.date], k: int = 5, seed: int = 42
) -> DailyLayout:
    """A daily run: stage some days of ``raw`` and bring all results up to date."""
    layout = DailyLayout(output_path)
    stage_days(raw, layout, days)
    write_results(raw.sparkSession, layout, k, seed)
    return layout


def labelled_incidents(spark: SparkSession, layout: DailyLayout, days: Sequence[dt.date] | None = None) -> DataFrame:
    """Accepted incidents with the cluster of their place (H6), of all days or of some."""
    staged = spark.read.schema(STAGED_SCHEMA).parquet(layout.days)
    chosen = (staged if days is None else _of_days(staged, days)).where("accepted")
    rows = spatial.extract_coordinates(chosen)
    labels = spark.read.parquet(layout.place_labels).select("location", "prediction")
    found = lookup_table(rows, labels, {"location": F.col("location")}, {"prediction": None})
    return clustering.cluster_rows(found)

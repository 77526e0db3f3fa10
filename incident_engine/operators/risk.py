"""Severity-weighted risk and hourly surge detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_engine import constants as C
from incident_engine.functions import scoring
from incident_engine.operators.common import descending_then, incidents, largest, top_k, total
from incident_engine.operators.lookups import lookup_table
from incident_engine.scratch import cut_lineage


def with_severity(df: DataFrame, column: str = "violation_type") -> DataFrame:
    """Add ``severity_score``."""
    return df.withColumn("severity_score", scoring.severity_weight(F.col(column)))


def hour_type_counts(clean: DataFrame) -> DataFrame:
    """Incidents per hour and type, null types kept (A10).

    The only pass over the incidents that the hourly results need: the severity depends on the
    type alone, so totals per hour are sums over these at most 24 rows per type.
    """
    return clean.groupBy(F.hour("timestamp_parsed").alias("Hour"), "violation_type").agg(
        F.count(F.lit(1)).alias("n")
    )


def primary_violation_per_hour(clean: DataFrame) -> DataFrame:
    """Top row per hour as an ordered window, with its count."""
    order = Window.partitionBy("Hour").orderBy(F.desc("v_count"), "violation_type")
    return (
        hour_type_counts(clean)
        .where(F.col("violation_type").isNotNull())
        .withColumnRenamed("n", "v_count")
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") == 1)
        .select("Hour", F.col("violation_type").alias("primary_violation"), "v_count")
    )


def volume_stats(hourly: DataFrame, column: str = "violation_count") -> DataFrame:
    """Mean and sample deviation of the hourly volume: one row."""
    return hourly.agg(
        F.avg(column).alias("mean_volume"), F.stddev_samp(column).alias("std_volume")
    )


def with_z_score(groups: DataFrame, column: str = "violation_count") -> DataFrame:
    """Add the rounded z-score of each group's volume against all groups.

    Input is a grouped result of at most a few rows (24 hours): the window puts them in one
    task, which saves computing the groups a second time for their mean. One group, or equal
    volumes, give 0.0.
    """
    everything = Window.partitionBy()
    gap = F.col(column) - F.avg(column).over(everything)
    spread = F.stddev_samp(column).over(everything)
    z = scoring.round_half_even(gap / F.when(spread > 0, spread), 2)
    return groups.withColumn("z_score", F.coalesce(z, F.lit(0.0)))


def group_stats(groups: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Number, mean and sample deviation of ``column`` per key (A12); partial moments are merged."""
    return groups.groupBy(*by).agg(
        F.count(column).alias("n_values"), F.avg(column).alias("mean_value"), F.stddev_samp(column).alias("std_value")
    )


def z_scores(groups: DataFrame, column: str, by: Sequence[str] = (), name: str = "z_score") -> DataFrame:
    """Add the rounded z-score of ``column``, among all rows or among those of the same key.

    Moments per key are aggregated and looked up again by the key, so no group of rows meets in one task,
    and a key that most rows have is no more work than others. One row, equal values, a null value or a
    null key give 0.0. The input, which is read twice, is stored once.
    """
    groups = cut_lineage(groups)
    stats = group_stats(groups, column, by)
    names = {c: f"__{c}" for c in ("mean_value", "std_value")}
    if by:
        stats = stats.select(*by, *(F.col(c).alias(n) for c, n in names.items()))
        known = lookup_table(groups, cut_lineage(stats), {k: F.col(k) for k in by}, dict.fromkeys(names.values()))
    else:
        known = groups.withColumns({n: stats.select(c).scalar() for c, n in names.items()})
    mean, std = (F.col(n) for n in names.values())
    z = scoring.round_half_even((F.col(column) - mean) / F.when(std > 0, std), 2)
    return known.select(*groups.columns, F.coalesce(z, F.lit(0.0)).alias(name))


def hourly_risk_from_counts(counts: DataFrame) -> DataFrame:
    """Hourly risk and anomaly table from :func:`hour_type_counts`.

    Volume, risk and top type of an hour come out of one aggregation, which takes the place of
    a join between two.
    """
    hourly = (
        with_severity(counts)
        .groupBy("Hour")
        .agg(
            F.sum("n").alias("violation_count"),
            F.sum(F.col("severity_score") * F.col("n")).alias("total_risk_score"),
            largest("violation_type", F.col("n")).alias("primary_violation"),
        )
    )
    return (
        with_z_score(hourly)
        .select(
            "Hour",
            "violation_count",
            "total_risk_score",
            (F.col("total_risk_score") / F.col("violation_count")).alias("avg_risk_score"),
            "primary_violation",
            "z_score",
            scoring.anomaly_level(F.col("z_score")).alias("anomaly_level"),
            scoring.is_anomaly(F.col("z_score")).alias("is_anomaly"),
        )
        .orderBy("Hour")
    )


def hourly_risk(clean: DataFrame) -> DataFrame:
    """Volume, risk, top type, z-score and anomaly class per hour."""
    return hourly_risk_from_counts(hour_type_counts(clean))


def time_type_matrix_from_counts(counts: DataFrame) -> DataFrame:
    """Hour x type counts and risk sums from :func:`hour_type_counts`."""
    return (
        with_severity(counts.where(F.col("violation_type").isNotNull()))
        .select(
            "Hour",
            "violation_type",
            F.col("n").alias("violation_count"),
            (F.col("severity_score") * F.col("n")).alias("total_risk_score"),
        )
        .orderBy("Hour", "violation_type")
    )


def time_type_matrix(clean: DataFrame) -> DataFrame:
    """Hour x type counts and risk sums."""
    return time_type_matrix_from_counts(hour_type_counts(clean))


def location_totals(
    clean: DataFrame,
    weight: str | None = None,
    high: int = C.HIGH_SEVERITY,
    extra: tuple[Column, ...] = (),
) -> DataFrame:
    """Volume, risk and number of severe incidents per location, unordered.

    ``extra`` aggregates are computed along with them.
    """
    severity = F.col("severity_score")
    return (
        with_severity(clean)
        .groupBy("location")
        .agg(
            incidents(weight).alias("total_violations"),
            total(severity, weight).alias("total_risk_score"),
            total((severity >= high).cast("bigint"), weight).alias("high_severity_count"),
            *extra,
        )
    )


def rank_location_risk(totals: DataFrame) -> DataFrame:
    """Location totals with their mean severity, riskiest first."""
    return totals.select(
        "location",
        "total_violations",
        "total_risk_score",
        (F.col("total_risk_score") / F.col("total_violations")).alias("avg_risk_score"),
        "high_severity_count",
    ).orderBy(*descending_then("total_risk_score", "location"))


def location_risk(
    clean: DataFrame, weight: str | None = None, high: int = C.HIGH_SEVERITY
) -> DataFrame:
    """Volume, mean and total risk and severe incidents per location (R2)."""
    return rank_location_risk(location_totals(clean, weight, high))


def top_risk_hours(hourly: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` hours with the most risk points (L4)."""
    return top_k(hourly, n, "total_risk_score", "Hour").select(
        "Hour", "total_risk_score", "anomaly_level"
    )

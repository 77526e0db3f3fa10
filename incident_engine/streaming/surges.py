"""The cleaning and hourly operators on a stream of raw incident files.

The same column logic as in batch: only the source, the watermark and the sink differ.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from incident_engine.constants import RAW_SCHEMA
from incident_engine.functions.text import null_if_na
from incident_engine.operators.cleaning import clean
from incident_engine.operators.risk import hour_type_counts, hourly_risk_from_counts


def stream_incidents(
    spark: SparkSession, path: str, file_format: str = "csv", files_per_batch: int | None = None
) -> DataFrame:
    """Raw incidents from CSV or parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if file_format != "csv":
        return reader.format(file_format).load(path)
    df = reader.option("header", True).option("enforceSchema", False).option("escape", '"').csv(path)
    return df.select(*(null_if_na(F.col(c)).alias(c) for c in df.columns))


def hourly_window_counts(raw: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Incidents per clock hour and type of a raw stream, final once ``delay`` has passed.

    Watermarks need zoned time: clock times are taken as if in UTC, whatever the session's zone.
    Rows behind the watermark are dropped, and which these are depends on how files fall into
    batches; :func:`dropped_groups` tells whether there were any, and :func:`open_windows` gives
    the hours that the watermark has not passed yet.
    """
    return _hours(
        clean(raw)
        .withColumn("event_time", _as_if_utc(F.col("timestamp_parsed")))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 hour"), "violation_type")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def open_windows(spark: SparkSession, state: str) -> DataFrame:
    """The windows of :func:`hourly_window_counts` still open in the checkpoint folder ``state``."""
    stored = spark.read.format("statestore").load(state)
    return _hours(stored.select("key.window", "key.violation_type", "value.count"))


def dropped_groups(job: StreamingQuery) -> int:
    """Groups (hour and type, per task) that a query dropped for coming behind the watermark.

    Counted over the progress reports that the session keeps
    (``spark.sql.streaming.numRecentProgressUpdates``).
    """
    states = (s for p in job.recentProgress for s in p["stateOperators"])
    return sum(s["numRowsDroppedByWatermark"] for s in states)


def _as_if_utc(clock: Column) -> Column:
    """The instant at which clocks in UTC show a zone-less time."""
    parts = [f(clock) for f in (F.year, F.month, F.dayofmonth, F.hour, F.minute)]
    return F.make_timestamp(*parts, F.date_part(F.lit("SECOND"), clock), F.lit("UTC"))


def _hours(counts: DataFrame) -> DataFrame:
    """Window starts as the zone-less times that clocks in UTC show."""
    since = F.make_dt_interval(secs=F.unix_seconds("window.start"))
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since
    return counts.select(start.alias("hour_start"), "violation_type", "count")


def surge_alerts(raw: DataFrame, sink: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """After each micro-batch hand ``sink`` the hourly risk table of all rows so far.

    The state is one counter per hour and type. A z-score compares all hours, so the table is
    recomputed from these counters each time.
    """

    def emit(counts: DataFrame, batch_id: int) -> None:
        sink(hourly_risk_from_counts(counts), batch_id)

    return hour_type_counts(clean(raw)).writeStream.outputMode("complete").foreachBatch(emit)

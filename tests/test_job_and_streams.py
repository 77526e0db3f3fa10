import datetime as dt
import pathlib
import time

import pytest
from helpers import hundred_incidents, raw_frame, values
from pyspark.sql import functions as F

from incident_engine import constants as C
from incident_engine import scratch
from incident_engine.operators import cleaning, clustering, locations, risk, spatial, temporal
from incident_engine.plans import daily
from incident_engine.plans.stages import run_pipeline
from incident_engine.sources import files, sinks, synth
from incident_engine.streaming import surges

ANCHOR = dt.date(2026, 1, 1)
RESULTS = {
    "time_type_aggregation.csv": C.TIME_TYPE_SCHEMA,
    "violations_per_location_csv": C.LOCATION_COUNT_SCHEMA,
    "top_locations_csv": C.LOCATION_COUNT_SCHEMA,
    "grid_counts_csv": C.GRID_COUNT_SCHEMA,
    "hotspot_clusters_csv": C.CLUSTER_SCHEMA,
    "cluster_centroids_csv": C.CENTROID_SCHEMA,
    "hourly_risk_anomaly_csv": C.HOURLY_RISK_SCHEMA,
    "location_risk_csv": C.LOCATION_RISK_SCHEMA,
    "time_type_matrix_csv": C.TIME_TYPE_MATRIX_SCHEMA,
}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def messy_raw(spark):
    """Synthetic rows over few places, plus rows that cleaning rejects."""
    base = synth.synthesize(spark, 2000, ANCHOR).selectExpr(
        "Violation_Id", "Timestamp", "Violation_Type",
        "concat_ws(',', round(split(Location, ',')[0], 2), round(split(Location, ',')[1], 2)) Location",
    )
    bad = raw_frame(
        spark,
        [
            (None, "2026-01-05 03:04:05", "DUI", "40.75,-73.98"),
            ("V9001", "junk", "DUI", "40.75,-73.98"),
            ("V9002", "2026-01-05 03:04:05", None, "Main St"),
            ("V9003", "2026-01-05 03:04:05", "DUI", None),
        ],
    )
    return base.unionByName(bad).cache()


def test_job_results_equal_the_single_operators(spark, messy_raw, tmp_path):
    source = str(tmp_path / "in")
    sinks.write_csv(messy_raw, source)
    seen = []
    layout = run_pipeline(spark, source, str(tmp_path / "out"), on_progress=lambda *a: seen.append(a))
    assert [(i, n) for i, n, _ in seen] == [(i, 6) for i in range(1, 7)]

    def result(name):
        return files.read_result_csv(spark, layout.output(name), RESULTS[name])

    clean = cleaning.clean(messy_raw)
    points = spatial.extract_coordinates(clean)
    assert rows(files.read_parquet(spark, layout.cleaned)) == rows(clean)
    per_hour = files.read_parquet(spark, layout.aggregation("per_hour"))
    assert rows(per_hour) == rows(temporal.count_by(clean))
    expected = {
        "time_type_aggregation.csv": temporal.time_type_aggregation(messy_raw),
        "violations_per_location_csv": locations.violations_per_location(messy_raw),
        "top_locations_csv": locations.top_locations(locations.location_counts(messy_raw)),
        "grid_counts_csv": spatial.grid_counts(points),
        "hourly_risk_anomaly_csv": risk.hourly_risk(clean),
        "location_risk_csv": risk.location_risk(clean),
        "time_type_matrix_csv": risk.time_type_matrix(clean),
    }
    for name, df in expected.items():
        assert rows(result(name)) == rows(df), name
        assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == RESULTS[name]
    labelled = clustering.cluster_hotspots(points)
    assert rows(result("hotspot_clusters_csv")) == rows(clustering.cluster_rows(labelled))
    assert rows(result("cluster_centroids_csv")) == rows(clustering.cluster_profile(labelled))
    ordered = [tuple(r) for r in result("top_locations_csv").collect()]
    assert ordered == values(expected["top_locations_csv"], "*")
    days = [r["DayOfWeek"] for r in result("time_type_aggregation.csv").collect()]
    assert [d for i, d in enumerate(days) if i == 0 or days[i - 1] != d] == list(C.DAY_ORDER)


def test_job_on_generated_rows_writes_every_output(spark, tmp_path):
    seen = []
    layout = run_pipeline(
        spark, None, str(tmp_path), generate=600, anchor=ANCHOR,
        on_progress=lambda *a: seen.append(a),
    )
    assert len(seen) == 7 and seen[-1][:2] == (7, 7)
    for name, schema in RESULTS.items():
        assert files.read_result_csv(spark, layout.output(name), schema).count() > 0
    assert files.read_incidents_csv(spark, layout.synthetic).count() == 600


def test_job_with_few_points_labels_them_zero(spark, tmp_path):
    source = str(tmp_path / "in")
    sinks.write_csv(
        raw_frame(spark, [(f"V{i}", "2026-01-05 03:04:05", "DUI", f"40.{i}5,-73.9") for i in range(3)]),
        source,
    )
    layout = run_pipeline(spark, source, str(tmp_path / "out"))
    labels = files.read_result_csv(spark, layout.output("hotspot_clusters_csv"), C.CLUSTER_SCHEMA)
    assert values(labels, "prediction") == [(0,)] * 3
    centres = files.read_result_csv(spark, layout.output("cluster_centroids_csv"), C.CENTROID_SCHEMA)
    assert values(centres, "violation_count", "dominant_violation") == [(3, "DUI")]


def test_job_needs_an_input(spark, tmp_path):
    with pytest.raises(ValueError):
        run_pipeline(spark, None, str(tmp_path))


def test_checkpoints_go_to_the_named_folder(spark):
    named = spark.conf.get(scratch.SETTING)
    assert scratch.shared_dir(spark) == named
    assert scratch.scratch_path(spark, "x").startswith(named)
    cut = scratch.cut_lineage(spark.range(10).groupBy("id").count())
    assert "Exchange" not in cut._jdf.queryExecution().executedPlan().toString()
    assert cut.count() == 10


def test_stream_in_two_files_equals_batch(spark, messy_raw, tmp_path):
    source = tmp_path / "in"
    ordered = messy_raw.orderBy("Violation_Id").coalesce(1).cache()
    sinks.write_csv(ordered.where("Violation_Id < 'V1'"), str(source))
    later = ordered.where("not coalesce(Violation_Id < 'V1', false)")
    later.write.mode("append").options(**sinks.CSV_OPTIONS).csv(str(source))
    tables = []
    job = (
        surges.surge_alerts(
            surges.stream_incidents(spark, str(source), files_per_batch=1),
            lambda table, batch: tables.append(rows(table)),
        )
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    assert len(tables) >= 2
    assert tables[-1] == rows(risk.hourly_risk(cleaning.clean(messy_raw)))
    ordered.unpersist()


def test_stream_windows_close_after_the_delay(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    clean = hundred_incidents(spark)
    raw = clean.selectExpr(
        "violation_id Violation_Id", "date_format(timestamp_parsed, 'yyyy-MM-dd HH:mm:ss') Timestamp",
        "violation_type Violation_Type", "location Location",
    )
    sinks.write_csv(raw, source)
    counts = surges.hourly_window_counts(surges.stream_incidents(spark, source), "2 hours")
    job = (
        counts.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(target)
    )
    job.awaitTermination()
    got = spark.read.parquet(target)
    last = dt.datetime(2026, 1, 5, 3)  # the 100th hour; windows must end two hours earlier
    assert got.agg({"hour_start": "max"}).first()[0] == last - dt.timedelta(hours=3)
    assert got.count() == 97 and {r["count"] for r in got.collect()} == {1}
    still = surges.open_windows(spark, str(tmp_path / "state"))
    assert still.dtypes == got.dtypes
    assert sorted(r["hour_start"] for r in still.collect()) == [last - dt.timedelta(hours=h) for h in (2, 1, 0)]
    assert surges.dropped_groups(job) == 0


@pytest.mark.parametrize("per_batch", [None, 1])
def test_stream_tells_of_late_rows_and_keeps_clock_hours_in_any_zone(spark, tmp_path, per_batch):
    source, state, target = (str(tmp_path / n) for n in ("in", "state", "out"))
    times = ["10:10:00", "20:10:00", "21:10:00", "22:10:00", "11:10:00", "02:30:00", "23:10:00"]
    for i, t in enumerate(times):
        one = raw_frame(spark, [(f"V{i}", f"2026-03-08 {t}", "DUI", "40.75,-73.98")])
        one.coalesce(1).write.mode("append").options(**sinks.CSV_OPTIONS).csv(source)
        time.sleep(1.1)  # files are taken in the order of their times
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # has no 02:30 on that day
    try:
        stream = surges.stream_incidents(spark, source, files_per_batch=per_batch)
        counts = surges.hourly_window_counts(stream, "1 hour")
        writer = counts.writeStream.format("parquet").option("checkpointLocation", state)
        job = writer.trigger(availableNow=True).start(target)
        job.awaitTermination()
        closed = [r["hour_start"].hour for r in spark.read.parquet(target).collect()]
        still = [r["hour_start"].hour for r in surges.open_windows(spark, state).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    hours = {int(t[:2]) for t in times}
    late = hours - set(closed) - set(still)
    assert len(closed + still) == len(set(closed + still)) and set(closed + still) <= hours
    assert late == (set() if per_batch is None else {2, 11})
    assert surges.dropped_groups(job) == len(late)


# ---- daily runs ------------------------------------------------------------------------------


DAYS = [dt.date(2026, 1, d) for d in (5, 6, 7)]


def delivered(spark, messy_raw, path):
    """Raw rows as CSV files in a folder per day of delivery, late rows and rejects among them."""
    day = F.expr("date_add(DATE '2026-01-05', cast(abs(hash(Violation_Id, Location)) % 3 as int))")
    frame = messy_raw.withColumn("day", day)
    frame.write.partitionBy("day").options(**sinks.CSV_OPTIONS).csv(path)
    return files.read_incidents_csv(spark, path)


def outputs(spark, layout):
    names = [n for n in RESULTS if n != "hotspot_clusters_csv"]
    return {n: rows(files.read_result_csv(spark, layout.output(n), RESULTS[n])) for n in names}


def test_daily_runs_equal_one_run_over_all_days(spark, messy_raw, tmp_path):
    raw = delivered(spark, messy_raw, str(tmp_path / "in"))
    assert dict(raw.dtypes)["day"] == "date"
    one = daily.run_days(raw, str(tmp_path / "one"), DAYS)
    for part in (DAYS[:2], DAYS[2:], DAYS[1:2]):  # a day more, then a day again
        step = daily.run_days(raw, str(tmp_path / "step"), part)
    assert outputs(spark, step) == outputs(spark, one)
    source = str(tmp_path / "whole")
    sinks.write_csv(messy_raw, source)
    whole = run_pipeline(spark, source, str(tmp_path / "whole_out"))
    assert outputs(spark, step) == outputs(spark, whole)
    stored = files.read_result_csv(spark, whole.output("hotspot_clusters_csv"), C.CLUSTER_SCHEMA)
    assert rows(daily.labelled_incidents(spark, step)) == rows(stored)


def test_a_daily_run_reads_and_replaces_its_day_only(spark, messy_raw, tmp_path):
    raw = delivered(spark, messy_raw, str(tmp_path / "in"))
    layout = daily.DailyLayout(str(tmp_path / "out"))
    daily.stage_days(raw, layout, DAYS[:2])
    before = {p: p.stat().st_mtime_ns for p in pathlib.Path(layout.days).glob("day=2026-01-05/*.parquet")}
    assert before
    smaller = raw.where("day <> DATE '2026-01-06' OR Violation_Id IS NOT NULL AND Location IS NOT NULL AND Timestamp LIKE '20%'")
    daily.stage_days(smaller, layout, DAYS[1:2])
    assert {p: p.stat().st_mtime_ns for p in pathlib.Path(layout.days).glob("day=2026-01-05/*.parquet")} == before
    staged = spark.read.parquet(layout.days)
    assert staged.where("day = DATE '2026-01-06' AND NOT accepted").count() == 0  # rejects of the first delivery are gone
    plan = daily._of_days(raw, DAYS[1:2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [(day" in plan
    with pytest.raises(ValueError, match="2030"):
        daily.stage_days(raw, layout, [dt.date(2030, 1, 1)])

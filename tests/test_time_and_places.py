import datetime as dt

import pytest
from helpers import at_hour, clean_frame, hundred_incidents, raw_frame, values

from incident_engine import constants as C
from incident_engine.operators import common, locations, temporal
from incident_engine.plans import views


def test_count_by_parts(spark):
    df = clean_frame(
        spark,
        [
            ("V1", dt.datetime(2026, 1, 5, 0), "DUI", "a"),
            ("V2", dt.datetime(2026, 1, 11, 23), "DUI", "a"),
            ("V3", dt.datetime(2025, 12, 31, 23), None, "a"),
        ],
    )
    assert values(temporal.count_by(df), "*") == [(0, 1), (23, 2)]
    assert values(temporal.count_by(df, "day_of_week"), "*") == [(1, 1), (3, 1), (7, 1)]
    assert values(temporal.count_by(df, "month"), "*") == [(1, 2), (12, 1)]
    assert values(temporal.count_by(df, "year"), "*") == [(2025, 1), (2026, 2)]
    with pytest.raises(ValueError):
        temporal.count_by(df, "week")


def test_time_type_rows_come_monday_first_and_use_raw_rows(spark):
    place = "40.758012,-73.985501"
    raw = raw_frame(
        spark,
        [
            ("V1", "2026-01-06 01:00:00", "Speeding", place),  # Tuesday
            ("V2", "2026-01-05 09:00:00", "Speeding", place),  # Monday
            ("V3", "2026-01-05 09:10:00", "DUI", place),
            (None, "2026-01-05 09:20:00", "DUI", None),
            ("V5", "2026-01-11 09:00:00", "DUI", place),  # Sunday
            ("V6", "bad", "DUI", place),
            ("V7", "2026-01-11 09:00:00", None, place),
        ],
    )
    expected = [
        ("Monday", 9, "DUI", 2),
        ("Monday", 9, "Speeding", 1),
        ("Tuesday", 1, "Speeding", 1),
        ("Sunday", 9, "DUI", 1),
    ]
    assert values(temporal.time_type_aggregation(raw), "*") == expected


def test_locations_use_raw_rows_without_null_places(spark):
    rows = [("V1", "bad", "DUI", p) for p in ("b", "a", "c", "c", None, "b")] + [
        (None, None, None, "a")
    ]
    raw = raw_frame(spark, rows)
    assert values(locations.violations_per_location(raw), "*") == [("a", 2), ("b", 2), ("c", 2)]
    counts = locations.location_counts(raw)
    assert values(locations.top_locations(counts, 2), "*") == [("a", 2), ("b", 2)]


def test_hot_location_is_folded_before_the_shuffle(spark):
    raw = raw_frame(spark, [("V1", "x", "DUI", "hot")] * 300 + [("V2", "x", "DUI", "cold")])
    df = locations.location_counts(raw)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange")
    assert dict(values(df, "*")) == {"hot": 300, "cold": 1}


def test_weighted_operators_agree_with_row_operators(spark):
    rows = [("V1", "x", "DUI", p) for p in "aabbbc"]
    raw = raw_frame(spark, rows)
    folded = raw.groupBy("Location").count().withColumnRenamed("count", "n")
    assert values(locations.violations_per_location(folded, weight="n"), "*") == values(
        locations.violations_per_location(raw), "*"
    )


def test_corridor_table(spark):
    counts = spark.createDataFrame(
        [("40.7,-73.9", 3), ("Main St", 9), (" 40.71x , -73.95", 2)]
        + [(f"40.{i},-73.{i}", 1) for i in range(20, 40)],
        C.LOCATION_COUNT_SCHEMA,
    )
    rows = views.corridor_table(counts).collect()
    assert len(rows) == 10
    assert tuple(rows[0]) == ("#1", "Main St", 9, 100, None, None)
    assert tuple(rows[1]) == ("#2", "40.7,-73.9", 3, 45, 40.7, -73.9)
    assert tuple(rows[2]) == ("#3", " 40.71x , -73.95", 2, 30, 40.71, -73.95)
    assert [r["Location"] for r in views.corridor_table(counts, "MAIN").collect()] == ["Main St"]
    assert views.corridor_table(counts, "nowhere").count() == 0
    beyond = views.corridor_table(counts, "-73.39").collect()  # the last of 23 places
    assert [(r["rank_label"], r["Location"]) for r in beyond] == [("#23", "40.39,-73.39")]
    assert [r["rank_label"] for r in views.corridor_table(counts, "#2").collect()] == [
        "#2", *(f"#{i}" for i in range(20, 24))
    ]
    assert views.corridor_table(counts.where("false"), "main").count() == 0
    assert views.corridors(counts).count() == 15


def test_ranks_of_a_whole_table(spark):
    df = spark.range(5000).selectExpr("id % 7 n", "cast(id as string) name").repartition(9)
    got = common.ranked_all(df, "n", "name").orderBy("rank").collect()
    want = sorted(((i % 7, str(i)) for i in range(5000)), key=lambda x: (-x[0], x[1]))
    assert [tuple(r) for r in got] == [(*x, k) for k, x in enumerate(want, 1)]


def test_domain_completion(spark):
    df = spark.createDataFrame([(3, 5), (3, 2), (30, 9)], "Hour int, count bigint")
    zero = dict(values(common.sum_over_domain(df, "Hour", range(24), "count", 0), "*"))
    assert zero == {h: 7 if h == 3 else 0 for h in range(24)}
    null = dict(values(common.sum_over_domain(df, "Hour", [3, 4], "count", None), "*"))
    assert null == {3: 7, 4: None}


def test_union_distinct_and_fallback(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([(2, "y"), (3, None)], "v int, k string")
    both = common.union_all(a, b)
    assert sorted(values(both, "k", "v"), key=repr) == [("x", 1), ("y", 2), (None, 3)]
    assert values(common.distinct_values(common.union_all(both, a), "k"), "k") == [("x",), ("y",)]
    assert sorted(values(common.coalesce_frames(a.limit(0), b), "k", "v"), key=repr) == [("y", 2), (None, 3)]
    assert values(common.coalesce_frames(a, b), "k", "v") == [("x", 1)]
    assert common.coalesce_frames(a.limit(0), b.limit(0)).count() == 0


def test_counts_conserve(spark):
    clean = hundred_incidents(spark).union(clean_frame(spark, [at_hour(3, None)]))
    per_hour = sum(n for _, n in values(temporal.count_by(clean), "*"))
    fine = temporal.weekday_hour_type_counts(clean)
    assert per_hour == sum(r["n"] for r in fine.collect()) == 101
    assert sum(r["count"] for r in temporal.named_time_type(fine).collect()) == 100

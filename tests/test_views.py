import json

import pytest
from helpers import hundred_incidents, point_frame, values

from incident_engine import constants as C
from incident_engine.operators import clustering, filters, risk
from incident_engine.plans import views
from incident_engine.sources import sinks

ROWS = [
    ("Monday", 8, "DUI", 4),
    ("Monday", 9, "Speeding", 6),
    ("Tuesday", 8, "Speeding", 1),
    ("Sunday", 20, "Illegal Turn", 7),
    ("Sunday", 20, "Other", 7),
]


@pytest.fixture
def time_type(spark):
    return spark.createDataFrame(ROWS, C.TIME_TYPE_SCHEMA)


@pytest.fixture
def places(spark):
    return spark.createDataFrame([("b", 9), ("a", 9), ("c", 1)], C.LOCATION_COUNT_SCHEMA)


@pytest.mark.parametrize(
    "types, days, kept",
    [
        (None, None, 5),
        ("ALL", "ALL", 5),
        (["DUI", "Speeding"], None, 3),
        (["DUI", "Speeding"], ["Monday"], 2),
        ("Speeding", "Tuesday", 1),
        ([], None, 0),
        (None, [], 0),
    ],
)
def test_selection(time_type, types, days, kept):
    assert filters.by_type_and_day(time_type, types, days).count() == kept


def test_kpis(time_type, places):
    row = views.kpis(time_type, places).first()
    assert tuple(row) == (25, "Illegal Turn", 7, "20:00", "a", 40 + 42 + 21 + 21, 124 / 25)
    part = views.kpis(time_type, places, ["DUI", "Speeding"], ["Monday", "Tuesday"]).first()
    assert tuple(part) == (11, "Speeding", 7, "09:00", "a", 82, 82 / 11)


def test_kpis_of_nothing(time_type, places):
    row = views.kpis(time_type, places.limit(0), types=[]).first()
    assert tuple(row) == (0, "N/A", 0, "N/A", "N/A", 0, 0.0)


def test_curves(time_type):
    curve = values(views.hourly_curve(time_type, days=["Monday"]), "*")
    assert [h for h, _ in curve] == list(range(24))
    assert {h: n for h, n in curve if n} == {8: 4, 9: 6}
    chosen = views.daily_distribution(time_type, ["DUI"], ["Sunday", "Monday"])
    assert values(chosen, "*") == [("Monday", 4), ("Sunday", None)]
    assert values(views.daily_distribution(time_type, days="Tuesday"), "*") == [("Tuesday", 1)]
    totals = values(views.daily_totals(time_type, "Speeding"), "*")
    assert totals == [(d, {"Monday": 6, "Tuesday": 1}.get(d, 0)) for d in C.DAY_ORDER]


def test_categories(time_type):
    assert values(views.category_breakdown(time_type), "*") == [
        ("DUI", 4), ("Illegal Turn", 7), ("Other", 7), ("Speeding", 7),
    ]
    down = views.category_breakdown(time_type, ascending=False)
    assert values(down, "Violation_Type")[0] == ("Illegal Turn",)
    assert values(views.category_list(time_type), "*") == [
        ("DUI",), ("Illegal Turn",), ("Other",), ("Speeding",),
    ]


def test_summary(spark, places):
    clean = hundred_incidents(spark)
    hourly = risk.hourly_risk(clean)
    centroids = spark.createDataFrame(
        [(1, 2.0, 2.0, 40, "DUI"), (0, 1.0, 1.0, 60, "Speeding")], C.CENTROID_SCHEMA
    )
    row = views.summary(hourly, places, centroids, n=2).first()
    assert (row["total_violations"], row["rush_hour_spike"]) == (100, "00:00")
    assert row["critical_spike_hours"] == [0, 1, 2, 3]
    assert [tuple(r) for r in row["top_locations"]] == [("a", 9), ("b", 9)]
    assert [r["cluster_id"] for r in row["clusters"]] == [0, 1]
    assert values(views.hotspots(centroids), "cluster_id") == [(0,), (1,)]
    assert values(views.hourly(hourly.limit(3)), "Hour") == [(0,), (1,), (2,)]


def test_summary_of_nothing(spark, places):
    none = spark.createDataFrame([], C.HOURLY_RISK_SCHEMA)
    no_centroids = spark.createDataFrame([], C.CENTROID_SCHEMA)
    row = views.summary(none, places.limit(0), no_centroids).first()
    assert tuple(row) == (0, "N/A", [], [], [])


def test_intensity_matrix(spark):
    wide = views.intensity_matrix(risk.time_type_matrix(hundred_incidents(spark)))
    assert wide.columns == ["violation_type", *(f"h{h:02d}" for h in range(24))]
    rows = {r["violation_type"]: r for r in wide.collect()}
    assert rows["DUI"]["h00"] == 5 and rows["DUI"]["h01"] == 0
    assert rows["Seatbelt Violation"]["h01"] == 5


def test_summary_as_json(spark, places):
    labelled = clustering.assign_nearest(
        point_frame(spark, [(40.7, -74.0)], kind=None), C.HOTSPOTS
    )
    summary = views.summary(
        risk.hourly_risk(hundred_incidents(spark)), places, clustering.cluster_profile(labelled)
    )
    payload = json.loads(sinks.json_rows(summary).first()["json"])
    assert payload["total_violations"] == 100
    assert payload["top_locations"][0] == {"Location": "a", "count": 9}
    assert payload["clusters"][0]["dominant_violation"] == C.DEFAULT_DOMINANT

import pytest
from helpers import at_hour, clean_frame, hundred_incidents, values
from pyspark.sql import functions as F

from incident_engine import constants as C
from incident_engine.functions import scoring
from incident_engine.operators import risk
from incident_engine.plans import views


@pytest.mark.parametrize(
    "kind, points",
    [*C.SEVERITY_WEIGHTS.items(), ("Unknown Violation", 3), (" DUI ", 10), (None, 3), ("dui", 3)],
)
def test_severity(spark, kind, points):
    df = spark.createDataFrame([(kind,)], "t string")
    assert df.select(scoring.severity_weight(F.col("t"))).first()[0] == points


def test_severity_default_is_a_parameter(spark):
    df = spark.createDataFrame([("other",)], "t string")
    assert df.select(scoring.severity_weight(F.col("t"), default=4)).first()[0] == 4


def test_hundred_incidents(spark):
    clean = hundred_incidents(spark)
    rows = risk.hourly_risk(clean).collect()
    assert [r["Hour"] for r in rows] == list(range(24))
    for r in rows:
        early, even = r["Hour"] < 4, r["Hour"] % 2 == 0
        count = 5 if early else 4
        points = 10 if even else 2
        assert tuple(r)[1:] == (
            count,
            count * points,
            float(points),
            "DUI" if even else "Seatbelt Violation",
            2.19 if early else -0.44,
            C.CRITICAL if early else C.NORMAL,
            early,
        )
    assert [tuple(r) for r in risk.location_risk(clean).collect()] == [
        ("40.7580,-73.9855", 100, 600, 6.0, 50)
    ]
    assert risk.time_type_matrix(clean).count() == 24
    stats = risk.volume_stats(risk.hourly_risk(clean)).first()
    assert stats["mean_volume"] == pytest.approx(100 / 24)
    assert stats["std_volume"] == pytest.approx(0.380693, abs=1e-6)


@pytest.mark.parametrize("hours", [[7, 7, 7], [1, 1, 2, 2, 3, 3]])
def test_no_spread_gives_zero_z(spark, hours):
    rows = risk.hourly_risk(clean_frame(spark, [at_hour(h) for h in hours])).collect()
    assert {(r["z_score"], r["anomaly_level"], r["is_anomaly"]) for r in rows} == {
        (0.0, C.NORMAL, False)
    }


def test_null_types_count_but_never_lead(spark):
    kinds = ["b", "b", "a", "a", None, None, None]
    rows = [at_hour(1, k) for k in kinds] + [at_hour(2, None)]
    clean = clean_frame(spark, rows)
    hourly = {r["Hour"]: r for r in risk.hourly_risk(clean).collect()}
    assert hourly[1]["primary_violation"] == "a"
    assert hourly[1]["violation_count"] == 7 and hourly[1]["total_risk_score"] == 21
    assert hourly[2]["primary_violation"] is None and hourly[2]["violation_count"] == 1
    assert values(risk.primary_violation_per_hour(clean), "*") == [(1, "a", 2)]
    matrix = values(risk.time_type_matrix(clean), "*")
    assert matrix == [(1, "a", 2, 6), (1, "b", 2, 6)]
    assert risk.location_risk(clean).first()["total_violations"] == 8


def test_padded_types_are_groups_of_equal_weight(spark):
    clean = clean_frame(spark, [at_hour(1, "DUI"), at_hour(1, " DUI ")])
    assert values(risk.time_type_matrix(clean), "*") == [(1, " DUI ", 1, 10), (1, "DUI", 1, 10)]


@pytest.mark.parametrize(
    "z, level, odd",
    [
        (2.0, C.CRITICAL, True),
        (1.99, C.ELEVATED, True),
        (1.5, C.ELEVATED, True),
        (1.49, C.NORMAL, False),
        (-1.49, C.NORMAL, False),
        (-1.5, C.LOW, True),
    ],
)
def test_classes(spark, z, level, odd):
    df = spark.range(1).select(scoring.anomaly_level(F.lit(z)), scoring.is_anomaly(F.lit(z)))
    assert tuple(df.first()) == (level, odd)


@pytest.mark.parametrize("value, expected", [(1.005, 1.0), (0.125, 0.12), (1.995, 2.0), (-0.001, 0.0)])
def test_rounding_half_even(spark, value, expected):
    got = spark.range(1).select(scoring.round_half_even(F.lit(value), 2)).first()[0]
    assert str(got) == str(expected)


def test_ratio_or_zero(spark):
    df = spark.range(1).select(
        scoring.ratio_or_zero(F.lit(6), F.lit(4)), scoring.ratio_or_zero(F.lit(6), F.lit(0))
    )
    assert tuple(df.first()) == (1.5, 0.0)


def test_location_risk_order_and_severe_count(spark):
    rows = [at_hour(1, "DUI", "b"), at_hour(1, "Red Light Violation", "a")]
    rows += [at_hour(1, "Illegal Turn", "a"), at_hour(1, "Speeding", "c")]
    assert values(risk.location_risk(clean_frame(spark, rows)), "*") == [
        ("a", 2, 10, 5.0, 1),
        ("b", 1, 10, 10.0, 1),
        ("c", 1, 6, 6.0, 0),
    ]


def test_hourly_risk_of_no_rows(spark):
    empty = risk.hourly_risk(clean_frame(spark, []))
    assert empty.count() == 0
    assert ", ".join(f"{n} {t}" for n, t in empty.dtypes) == C.HOURLY_RISK_SCHEMA


def test_hourly_risk_scans_once_without_joins(spark):
    plan = risk.hourly_risk(hundred_incidents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_anomaly_audit(spark):
    hourly = spark.createDataFrame(
        [
            (16, 9, 50, 5.5, "DUI", 2.21, C.CRITICAL, True),
            (3, 1, 3, 3.0, None, -1.5, C.LOW, True),
            (9, 4, 12, 3.0, "", 0.0, None, False),
        ],
        C.HOURLY_RISK_SCHEMA,
    )
    assert values(views.anomaly_audit(hourly), "*") == [
        ("03:00", 1, "3 pts", "-1.50", C.LOW, C.DEFAULT_PRIMARY, C.PATROL_ACTIONS[C.LOW]),
        ("09:00", 4, "12 pts", "0.00", C.NORMAL, C.DEFAULT_PRIMARY, C.DEFAULT_ACTION),
        ("16:00", 9, "50 pts", "+2.21", C.CRITICAL, "DUI", C.PATROL_ACTIONS[C.CRITICAL]),
    ]
    assert values(views.critical_alert(hourly), "*") == [("16:00", 1)]
    assert views.critical_alert(hourly.where("Hour = 3")).count() == 0
    assert values(risk.top_risk_hours(hourly, 1), "Hour") == [(16,)]

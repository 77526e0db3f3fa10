import hashlib
import itertools
import math
import random
import statistics

import pytest
from helpers import point_frame, values

from incident_engine import constants as C
from incident_engine.functions.geo import METRES_PER_DEGREE, HexGrid
from incident_engine.operators import clustering, spatial
from incident_engine.plans import views


def two_clouds():
    draw = random.Random(42)
    return [
        (draw.gauss(a, 0.01), draw.gauss(b, 0.01))
        for a, b in [(40.7, -74.0), (40.8, -73.9)]
        for _ in range(50)
    ]


def nearest(point, centres):
    return min(range(len(centres)), key=lambda i: (math.dist(point, centres[i]), i))


def plain_lloyd(points, centres, max_iter=100):
    """The same algorithm over a list, to compare with."""
    for _ in range(max_iter):
        labels = [nearest(p, centres) for p in points]
        moved = []
        for j, old in enumerate(centres):
            members = [p for p, label in zip(points, labels) if label == j]
            moved.append(
                tuple(statistics.fmean(axis) for axis in zip(*members)) if members else old
            )
        pairs = list(zip(itertools.chain(*centres), itertools.chain(*moved)))
        if all(abs(a - b) <= 1e-5 + 1e-5 * abs(b) for a, b in pairs):
            break
        centres = moved
    return labels


def test_only_plain_pairs_are_coordinates(spark):
    texts = [
        "40.75,-73.98", "999.9,-999.9", "-0.0,0.0", "40.75, -73.98", "40,-73", "x40.75,-73.98",
        "40.75,-73.98x", "Main St & 5th Ave", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "location string")
    got = values(spatial.extract_coordinates(df), "lat", "lon")
    assert got == [(40.75, -73.98), (999.9, -999.9), (-0.0, 0.0)]


def test_grid_floors_toward_minus_infinity(spark):
    points = point_frame(spark, [(40.758, -73.9855), (40.759, -73.9801), (40.76, -73.98)])
    assert values(spatial.grid_counts(points), "*") == [("4075_-7399", 2), ("4076_-7398", 1)]
    assert values(spatial.grid_counts(points, cells_per_degree=1), "*") == [("40_-74", 3)]
    assert values(spatial.top_grids(spatial.grid_counts(points), 1), "grid_id") == [("4075_-7399",)]


def test_numeric_coordinates(spark):
    df = spark.createDataFrame(
        [("1.5", "2"), ("x", "2"), (None, "2"), ("NaN", "1")], "lat string, lon string"
    )
    assert values(spatial.numeric_coordinates(df), "*") == [(1.5, 2.0)]


def test_hexagons_hold_points_within_their_radius(spark):
    grid = HexGrid(140.0)
    points = two_clouds()
    cells = spatial.hexbin_density(point_frame(spark, points), grid).collect()
    assert sum(c["count"] for c in cells) == len(points)
    centres = [
        (c["center_lon"] * grid.metres_per_lon, c["center_lat"] * METRES_PER_DEGREE) for c in cells
    ]
    for lat, lon in points:
        here = (lon * grid.metres_per_lon, lat * METRES_PER_DEGREE)
        assert min(math.dist(here, c) for c in centres) <= 140.0 + 0.2


def test_nearest_centre_and_ties(spark):
    centres = [(0.0, 0.0), (0.0, 2.0), (5.0, 5.0)]
    points = [(0.0, 1.0), (0.0, 1.1), (4.0, 4.0), (-1.0, 0.0)]
    labels = values(clustering.assign_nearest(point_frame(spark, points), centres), "prediction")
    assert labels == [(0,), (1,), (2,), (0,)]


def test_lloyd_matches_a_plain_loop(spark):
    points = two_clouds()
    start = [points[3], points[60], (0.0, 0.0)]
    df = point_frame(spark, points)
    labelled = clustering.lloyd_clusters(df, start).orderBy("violation_id")
    assert [r["prediction"] for r in labelled.collect()] == plain_lloyd(points, start)
    one_pass = clustering.lloyd(df, start, max_iter=1)
    assert one_pass.iterations == 1 and list(one_pass.centres) == start


def test_lloyd_step_keeps_a_centre_without_members(spark):
    df = point_frame(spark, [(1.0, 1.0), (3.0, 1.0)])
    step = clustering.lloyd_step(df, [(2.0, 1.0), (90.0, 90.0)]).orderBy("cluster_id")
    assert values(step, "*") == [(0, 2.0, 1.0, 2), (1, 90.0, 90.0, 0)]


def test_kmeans_finds_two_clouds(spark):
    df = point_frame(spark, two_clouds())
    labelled = clustering.cluster_hotspots(df, k=2)
    labels = [r["prediction"] for r in labelled.orderBy("violation_id").collect()]
    assert labels == [0] * 50 + [1] * 50
    assert values(clustering.cluster_sizes(labelled), "*") == [(0, 50), (1, 50)]


def test_kmeans_does_not_depend_on_the_input_layout(spark):
    draw = random.Random(1)
    points = [(draw.uniform(40, 41), draw.uniform(-74, -73)) for _ in range(400)]
    shuffled = points[:]
    draw.shuffle(shuffled)
    one = clustering.kmeans_centres(point_frame(spark, points).coalesce(1))
    many = clustering.kmeans_centres(point_frame(spark, shuffled).repartition(7))
    assert [tuple(map(lambda v: round(v, 9), c)) for c in one] == [
        tuple(map(lambda v: round(v, 9), c)) for c in many
    ]


def test_kmeans_weights_equal_repeated_rows(spark):
    points = two_clouds()[:20]
    repeated = point_frame(spark, [p for i, p in enumerate(points) for _ in range(i + 1)])
    folded = repeated.groupBy("lat", "lon").count()
    a = clustering.kmeans_centres(repeated, k=3)
    b = clustering.kmeans_centres(folded, k=3, weight="count")
    assert [round(v, 9) for c in a for v in c] == [round(v, 9) for c in b for v in c]


@pytest.mark.parametrize("n", [0, 1, 4])
def test_too_few_points_share_label_zero(spark, n):
    labelled = clustering.cluster_hotspots(point_frame(spark, [(40.0 + i, -73.0) for i in range(n)]))
    assert values(labelled, "prediction") == [(0,)] * n


def test_profile(spark):
    rows = [
        ("V1", 1.0, 1.0, "b", 0),
        ("V2", 3.0, 2.0, "a", 0),
        ("V3", 2.0, 3.0, "b", 0),
        ("V4", 2.0, 2.0, "a", 0),
        ("V5", 5.0, 5.0, None, 1),
    ]
    labelled = spark.createDataFrame(
        rows, "violation_id string, lat double, lon double, violation_type string, prediction int"
    )
    profile = clustering.cluster_profile(labelled)
    assert values(profile, "*") == [
        (0, 2.0, 2.0, 4, "a"),
        (1, 5.0, 5.0, 1, C.DEFAULT_DOMINANT),
    ]
    assert views.centroid_table(profile).columns == list(C.CENTROID_TITLES.values())
    assert values(clustering.map_centre(labelled), "*") == [(2.6, 2.6)]
    assert clustering.cluster_rows(labelled.drop("violation_type")).columns == [
        "violation_id", "lat", "lon", "prediction",
    ]


def test_sample_is_the_same_on_any_layout(spark):
    labelled = clustering.assign_nearest(point_frame(spark, two_clouds()), C.HOTSPOTS)
    a = values(clustering.incident_sample(labelled.coalesce(1), 10), "violation_id")
    b = values(clustering.incident_sample(labelled.repartition(6), 10), "violation_id")
    assert a == b and len(set(a)) == 10
    assert clustering.incident_sample(labelled, 1000).count() == 100
    assert clustering.initial_centres(labelled.coalesce(1), 3) == clustering.initial_centres(
        labelled.repartition(5), 3
    )


def test_map_views(spark):
    labelled = clustering.assign_nearest(point_frame(spark, C.HOTSPOTS), C.HOTSPOTS)
    rows = views.map_view(labelled).orderBy("prediction").collect()
    assert [tuple(r["color"]) for r in rows] == list(C.CLUSTER_RGBA.values())
    assert [r["color_hex"] for r in rows] == list(C.CLUSTER_HEX.values())
    assert views.map_view(labelled, "hexagons").count() == 5
    with pytest.raises(ValueError):
        views.map_view(labelled, "pie")


def test_points_stay_in_one_stage(spark):
    df = clustering.assign_nearest(point_frame(spark, two_clouds()), C.HOTSPOTS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan


@pytest.mark.parametrize("places", [1, 2, 4, 5, 6])
def test_hotspots_of_few_distinct_places(spark, places):
    rows = [(f"V{i:04d}", 40.7 + (i % places) / 100, -73.9, "DUI") for i in range(60)]
    df = spark.createDataFrame(rows, "violation_id string, lat double, lon double, violation_type string")
    labelled = clustering.cluster_hotspots(df)
    found = labelled.groupBy("prediction").count().collect()
    assert sum(r["count"] for r in found) == 60
    assert len(found) == min(places, 5)


def plain_kmeans_start(places, k, seed, rounds):
    """k-means|| by definition over (lat, lon, weight)."""

    def draw(turn, a, b):
        text = f"{seed}:{turn}:{round(a * 1e6)},{round(b * 1e6)}"
        return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2**32

    def gap(p, centres):
        return min((p[0] - c[0]) ** 2 + (p[1] - c[1]) ** 2 for c in centres)

    found = [min(places, key=lambda p: (draw(0, *p[:2]), p))[:2]]
    for turn in range(1, rounds + 1):
        cost = {p: p[2] * gap(p, found) for p in places}
        total = sum(cost.values())
        found += sorted(p[:2] for p in places if draw(turn, *p[:2]) * total < cost[p] * 2 * k)
    weights = [0.0] * len(found)
    for p in places:
        weights[min(range(len(found)), key=lambda i: (math.dist(p[:2], found[i]), i))] += p[2]
    chosen = [min(zip(found, weights), key=lambda c: (-c[1], c[0]))[0]]
    while len(chosen) < k:
        left = [(c, w) for c, w in zip(found, weights) if c not in chosen]
        chosen.append(min(left, key=lambda c: (-c[1] * gap(c[0], chosen), c[0]))[0])
    return chosen


@pytest.mark.parametrize("k,seed", [(2, 1), (5, 42), (9, 7)])
def test_kmeans_start_equals_the_definition(spark, k, seed):
    rnd = random.Random(seed)
    places = [(round(rnd.gauss(40 + i % 4, 0.1), 4), round(rnd.gauss(-73 - i % 3, 0.1), 4), float(rnd.randint(1, 9))) for i in range(200)]
    compact = spark.createDataFrame(places, "lat double, lon double, weight double")
    assert clustering.kmeans_start(compact.repartition(5), k, seed) == plain_kmeans_start(places, k, seed, clustering.ROUNDS)


def test_kmeans_start_fills_up_when_draws_find_too_few(spark):
    places = [(0.0, 0.0, 1e9), (1.0, 0.0, 1e-9), (0.0, 2.0, 1e-9), (3.0, 3.0, 1e9)]
    compact = spark.createDataFrame(places, "lat double, lon double, weight double")
    assert sorted(clustering.kmeans_start(compact, 3)) in ([c[:2] for c in three] for three in itertools.combinations(sorted(places), 3))
    same = spark.createDataFrame([(1.0, 1.0, 1.0), (1.0, 1.0 + 2e-200, 1.0)], "lat double, lon double, weight double")
    assert clustering.kmeans_start(same, 5) == [(1.0, 1.0)]


def test_kmeans_is_not_far_from_the_best_of_many_starts(spark):
    rnd = random.Random(5)
    points = [(rnd.gauss(a, 0.02), rnd.gauss(b, 0.02)) for a, b in C.HOTSPOTS for _ in range(60)]
    centres = clustering.kmeans_centres(point_frame(spark, points))

    def cost(cs):
        return sum(min(math.dist(p, c) ** 2 for c in cs) for p in points)

    best = min(cost(plain_lloyd_centres(points, rnd.sample(points, 5))) for _ in range(20))
    assert cost(centres) <= 1.3 * best


def plain_lloyd_centres(points, centres, passes=30):
    for _ in range(passes):
        groups = [[] for _ in centres]
        for p in points:
            groups[min(range(len(centres)), key=lambda i: math.dist(p, centres[i]))].append(p)
        centres = [tuple(sum(v) / len(g) for v in zip(*g)) if g else c for g, c in zip(groups, centres)]
    return centres


def test_feature_vectors(spark):
    df = clustering.feature_vectors(point_frame(spark, [(1.0, 2.0)]))
    assert df.first()["features"].toArray().tolist() == [1.0, 2.0]


# ---- samples ---------------------------------------------------------------------------------


def test_fraction_sample(spark):
    labelled = clustering.assign_nearest(point_frame(spark, two_clouds() * 20), C.HOTSPOTS)
    ids = lambda f, df=labelled: {r[0] for r in values(clustering.incident_fraction(df, f), "violation_id")}
    assert ids(0.0) == set() and len(ids(1.0)) == 2000
    assert ids(0.1) < ids(0.3) and ids(0.3) == ids(0.3, labelled.repartition(7))
    assert abs(len(ids(0.3)) - 600) < 90
    plan = clustering.incident_fraction(labelled, 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    with pytest.raises(ValueError):
        clustering.incident_fraction(labelled, 1.5)


def test_sample_per_cluster_has_exact_sizes(spark):
    sizes = {0: 500, 1: 3, 2: 40}
    rows = [(f"V{c}-{i}", 1.0, 2.0, "x", c) for c, n in sizes.items() for i in range(n)]
    schema = "violation_id string, lat double, lon double, violation_type string, prediction int"
    labelled = spark.createDataFrame(rows, schema)
    got = values(clustering.incident_sample_per_cluster(labelled.repartition(6), 40), "prediction", "violation_id")
    for c, n in sizes.items():
        names = sorted((f"V{c}-{i}" for i in range(n)), key=lambda v: (hashlib.md5(v.encode()).hexdigest(), v))
        assert {v for p, v in got if p == c} == set(names[:40])
    plan = clustering.incident_sample_per_cluster(labelled, 40)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # before and after the shuffle
    assert clustering.incident_sample_per_cluster(labelled.where("false"), 4).count() == 0

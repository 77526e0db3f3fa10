"""Lookups in tables, nearest centres from a table, grouped z-scores, completion, ranks and bundles."""

import math
import random
import statistics

import pytest
from helpers import values

from incident_engine import constants as C
from incident_engine.functions import text
from incident_engine.operators import common, locations, lookups, nearest, risk
from incident_engine.plans import views
from incident_engine.sources import files, sinks
from pyspark.sql import functions as F


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- lookup in a table -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def facts(spark):
    rows = [(i, "hot" if i % 3 else f"k{i % 50}", i % 2) for i in range(900)] + [(900 + i, None, i % 2) for i in range(400)]
    return spark.createDataFrame(rows, "id int, name string, part int").repartition(6)


@pytest.fixture(scope="module")
def dim(spark):
    rows = [("hot", 0, 1.5, "h")] + [(f"k{i}", 0, float(i), None) for i in range(40)] + [("unused", 0, 9.0, "u"), (None, 0, 7.0, "n"), (None, 0, 8.0, "n")]
    return spark.createDataFrame(rows, "name string, part int, points double, tag string")


def want(facts, dim, with_part):
    table = {(r.name, r.part) if with_part else r.name: (r.points, r.tag) for r in dim.collect() if r.name is not None}
    return sorted((r.id, r.name, r.part, *table.get((r.name, r.part) if with_part else r.name, (-1.0, "?"))) for r in facts.collect() if r.name) + [
        (r.id, None, r.part, -1.0, "?") for r in sorted(facts.where("name IS NULL").collect())
    ]


@pytest.mark.parametrize("limit", [0, lookups.BROADCAST_BYTES])
@pytest.mark.parametrize("with_part", [False, True])
def test_lookup_gives_each_fact_one_row(facts, dim, limit, with_part):
    keys = {"name": F.col("name"), **({"part": F.col("part")} if with_part else {})}
    found = lookups.lookup_table(facts, dim, keys, {"points": -1.0, "tag": "?"}, broadcast_bytes=limit)
    assert found.columns == ["id", "name", "part", "points", "tag"]
    got = sorted((tuple(r) for r in found.collect()), key=lambda r: (r[1] is None, r[0]))
    assert got == want(facts, dim, with_part)


def test_the_measured_size_picks_the_join(facts, dim):
    keys = {"name": F.col("name")}
    small = plan_of(lookups.lookup_table(facts, dim, keys, {"points": None}))
    assert "BroadcastHashJoin" in small and "SortMergeJoin" not in small
    large = plan_of(lookups.lookup_table(facts, dim, keys, {"points": None}, broadcast_bytes=0))
    assert "SortMergeJoin" in large and "Cartesian" not in large


def test_measured_size(dim):
    size = lookups.measured(dim, ["name"])
    assert (size.rows, size.repeats) == (44, 1)
    assert size.bytes >= 44 * lookups.ROW_BYTES
    assert lookups.measured(dim.where("false"), ["name"]) == (0, 0, 0)
    assert lookups.measured(dim, ["part"]).repeats == 44


def test_hot_keys_are_few_and_found(facts):
    found = {r.name for r in lookups.hot_keys(facts, ["name"], share=4).collect()}
    assert found == {"hot", None}
    assert lookups.hot_keys(facts, ["name"], share=1).count() == 0


def test_double_keys_and_clashes_are_refused(spark, facts, dim):
    twice = dim.unionByName(dim.where("name = 'hot'"))
    with pytest.raises(ValueError, match="2 rows"):
        lookups.lookup_table(facts, twice, {"name": F.col("name")}, {"points": 0.0})
    with pytest.raises(ValueError, match="part"):
        lookups.lookup_table(facts, dim, {"name": F.col("name")}, {"part": 0})


def test_lookup_in_and_of_nothing(facts, dim):
    for limit in (0, 1000):
        none = lookups.lookup_table(facts, dim.where("false"), {"name": F.col("name")}, {"tag": "?"}, broadcast_bytes=limit)
        assert {r.tag for r in none.collect()} == {"?"}
        assert lookups.lookup_table(facts.where("false"), dim, {"name": F.col("name")}, {"tag": "?"}, broadcast_bytes=limit).count() == 0


def test_lookup_by_a_trimmed_key(spark):
    df = spark.createDataFrame([(" DUI ",), ("x",), (None,)], "violation_type string")
    table = spark.createDataFrame(list(C.SEVERITY_WEIGHTS.items()), "kind string, points int")
    found = lookups.lookup_table(df, table, {"kind": text.strip(F.col("violation_type"))}, {"points": C.DEFAULT_SEVERITY})
    assert values(found.orderBy("points", "violation_type"), "*") == [(None, 3), ("x", 3), (" DUI ", 10)]


# ---- nearest centre from a table -------------------------------------------------------------


def check_nearest(spark, points, centres):
    p = spark.createDataFrame(points, "lat double, lon double")
    c = spark.createDataFrame([(i, *xy) for i, xy in enumerate(centres)], "cluster_id int, center_lat double, center_lon double")
    got = {(r.lat, r.lon): (r.prediction, r.distance) for r in nearest.nearest_places(p, c).collect()}
    for a, b in points:
        d = [math.sqrt((a - x) * (a - x) + (b - y) * (b - y)) for x, y in centres]
        assert got[a, b] == (d.index(min(d)), min(d))


def layouts():
    rnd = random.Random(9)
    cloud = lambda n, s, at=0.0: [(rnd.gauss(at, s), rnd.gauss(at, s)) for _ in range(n)]
    ring = [(math.cos(a), math.sin(a)) for a in (rnd.uniform(0, 6.3) for _ in range(120))]
    grid = [(float(rnd.randint(0, 4)), float(rnd.randint(0, 4))) for _ in range(60)]
    return {
        "even": (cloud(300, 1), cloud(90, 1)),
        "dense and far": (cloud(200, 1), cloud(150, 1e-4, 5.0)),
        "ring": (cloud(150, 1e-3), ring),
        "ties": (list(set(grid)), grid),
        "one centre": (cloud(50, 1), [(3.0, 3.0)]),
        "one place": ([(1.0, 1.0)], cloud(40, 1)),
        "all in one": ([(1.0, 1.0)], [(1.0, 1.0)] * 3),
        "a line": ([(0.0, float(i)) for i in range(60)], [(0.0, i * 7.3) for i in range(30)]),
        "scales": (cloud(100, 1e-6) + cloud(100, 1e3), cloud(40, 1e-6) + cloud(40, 1e3)),
    }


@pytest.mark.parametrize("name", layouts())
def test_nearest_equals_a_plain_search(spark, name):
    check_nearest(spark, *layouts()[name])


def test_nearest_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BROADCAST_ROWS", 0)
    check_nearest(spark, *layouts()["even"])


def test_nearest_keeps_every_row(spark):
    rows = [(1, 0.0, 0.0), (2, None, 1.0), (3, math.nan, 1.0), (4, math.inf, 1.0)] + [(5, 2.0, 2.0)] * 50
    points = spark.createDataFrame(rows, "id int, lat double, lon double")
    centres = spark.createDataFrame(
        [(7, 2.0, 1.0), (9, 0.0, 0.5), (8, 0.0, 0.5), (None, 0.0, 0.0), (1, None, 0.0), (2, math.nan, 0.0)],
        "cluster_id int, center_lat double, center_lon double",
    )
    found = nearest.nearest_in_table(points, centres)
    got = sorted((r.id, r.prediction, r.distance) for r in found.collect())
    assert got == [(1, 8, 0.5), (2, None, None), (3, None, None), (4, None, None)] + [(5, 7, 1.0)] * 50
    assert {r.prediction for r in nearest.nearest_in_table(points, centres.where("false")).collect()} == {None}
    assert nearest.nearest_in_table(points.where("false"), centres).count() == 0


# ---- z-scores --------------------------------------------------------------------------------


def test_z_scores_per_key(spark):
    rnd = random.Random(2)
    rows = [(k, h, rnd.randint(1, 40)) for k in "abc" for h in range(9)] + [("one", 0, 5), ("same", 0, 4), ("same", 1, 4), (None, 0, 3), (None, 1, 9), ("a", 9, None)]
    df = spark.createDataFrame(rows, "k string, h int, n int")
    got = {(r.k, r.h): r.z_score for r in risk.z_scores(df, "n", ["k"]).collect()}
    for k, h, n in rows:
        group = [v for kk, _, v in rows if kk == k and v is not None]
        z = 0.0
        if k is not None and n is not None and len(group) > 1 and statistics.stdev(group):
            z = round((n - statistics.mean(group)) / statistics.stdev(group) * 100) / 100
        assert got[k, h] == z, (k, h)
    assert "SinglePartition" not in plan_of(risk.z_scores(df, "n", ["k"]))


def test_z_scores_among_all_rows_equal_the_hourly_ones(spark):
    df = spark.createDataFrame([(h, h * h % 7) for h in range(24)], "Hour int, violation_count int")
    assert sorted(values(risk.z_scores(df, "violation_count"), "*")) == sorted(values(risk.with_z_score(df), "*"))
    assert "Window" not in plan_of(risk.z_scores(df, "violation_count"))
    assert risk.z_scores(df.where("false"), "violation_count").count() == 0


# ---- completion ------------------------------------------------------------------------------


def test_complete_over_several_keys(spark):
    df = spark.createDataFrame([(4, "a", 0, "x"), (5, "a", 1, None), (6, "z", 0, "x"), (7, None, 0, "x")], "n bigint, k string, h int, note string")
    domain = common.product(spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string"), {"h": [0, 1, 2]})
    got = sorted(values(common.complete(df, domain, {"n": 0}), "k", "h", "n", "note"), key=repr)
    assert got == sorted(
        [("a", 0, 4, "x"), ("a", 1, 5, None), ("a", 2, 0, None), ("b", 0, 0, None), ("b", 1, 0, None), ("b", 2, 0, None)], key=repr
    )
    full = common.complete(df.where("false"), domain, {"n": 1, "note": "none"})
    assert full.count() == 6 and full.dtypes == df.dtypes
    assert common.complete(df, domain.where("false"), {}).count() == 0


# ---- ranks of found rows ---------------------------------------------------------------------


def test_search_ranks_equal_the_numbered_table(spark):
    rnd = random.Random(4)
    rows = [(f"{rnd.choice(['Main', 'Oak', 'Elm'])} St {i}", rnd.randint(1, 30)) for i in range(200)]
    counts = spark.createDataFrame(rows, "Location string, count bigint").repartition(5)
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for query in ("oak", "ELM ST 1", "st", "nothing", "1", "#1", "#", "12"):
        shown = [f"#{i}\t{place}\t{n}" for i, (place, n) in enumerate(order, 1)]
        expected = [s.split("\t")[:2] for s in shown if query.lower() in s.lower()][:10]
        got = values(views.corridor_table(counts, query), "rank_label", "Location")
        assert [list(r) for r in got] == expected, query


def test_found_rows_are_ranked_without_a_sort_of_the_table(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 2)], "Location string, count bigint")
    plan = plan_of(common.ranks_of(locations.top_locations(counts, 1), counts, 1, "count", "Location"))
    assert "Sort " not in plan and "rangepartitioning" not in plan and "Window" not in plan


# ---- bundles and labels ----------------------------------------------------------------------


def test_bundle_members_come_from_one_parse(spark, tmp_path):
    path = str(tmp_path / "bundle")
    places = spark.createDataFrame([("a", 1), (None, 2)], C.LOCATION_COUNT_SCHEMA)
    hours = spark.createDataFrame([], C.PER_HOUR_SCHEMA)
    sinks.write_bundle(path, {"places": places, "hours": hours})
    read = files.read_bundle_members(spark, path, {"places": C.LOCATION_COUNT_SCHEMA, "hours": C.PER_HOUR_SCHEMA, "gone": "x int"})
    assert sorted(values(read["places"], "*"), key=repr) == sorted([("a", 1), (None, 2)], key=repr)
    assert read["hours"].count() == 0 and read["gone"].count() == 0
    assert all("Scan json" not in plan_of(df) for df in read.values())


def test_fallback_is_one_lazy_plan(spark):
    a = spark.createDataFrame([(1,)], "v int")
    plan = plan_of(common.coalesce_frames(a.where("v > 1"), a))
    assert "Subquery" in plan and "Union" in plan


def test_thousands(spark):
    df = spark.createDataFrame([(0, 0.0), (999, 0.5), (-1234567, 1234.56), (None, None)], "n bigint, x double")
    got = values(df.select(text.thousands(F.col("n")).alias("n"), text.thousands(F.col("x"), 1).alias("x")), "*")
    assert got == [("0", "0.0"), ("999", "0.5"), ("-1,234,567", "1,234.6"), (None, None)]

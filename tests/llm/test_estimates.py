"""Loops of the corpus operators: the planner's sizes stay small numbers, and a round costs few tasks."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from incident_engine import scratch
from incident_engine.llm import ann, components


def digits(df, capsys):
    """Decimal digits of the largest size that the planner works with."""
    capsys.readouterr()
    df.explain(mode="cost")
    return max([int(e) for e in re.findall(r"sizeInBytes=[0-9.]+E\+(\d+)", capsys.readouterr().out)], default=0)


def path(spark, n):
    """Links of one path through nodes numbered out of order, with loops and links told twice."""
    order = [(7 * i) % n for i in range(n)]
    links = [*zip(order[:-1], order[1:]), *zip(order[1:], order[:-1]), (3, 3), (n, n), (n + 1, n + 2), (None, 1)]
    return spark.createDataFrame(links, "a long, b long")


def test_components_of_a_path_keep_small_estimates(spark, capsys):
    found = components.components(path(spark, 300))
    assert digits(found, capsys) < 100
    assert dict(found.collect()) == {i: 0 for i in range(300)} | {301: 301, 302: 301}


def test_a_round_of_components_reads_its_links_once(spark):
    links = path(spark, 64).repartition(8).checkpoint()
    sc = spark.sparkContext
    sc.setJobGroup("rounds of components", "")
    try:
        components.components(links)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("rounds of components") for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(x.numTasks for s in stages if (x := tracker.getStageInfo(s)))
    assert 0 < tasks < 1000


def test_no_links_give_no_components(spark):
    assert components.components(spark.createDataFrame([(4, 4)], "a long, b long")).collect() == []


def test_a_search_keeps_small_estimates(spark, capsys):
    rng = np.random.default_rng(3)
    rows = [(i, [float(y) for y in x]) for i, x in enumerate(rng.standard_normal((600, 6)))]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 50 == 0)
    assert digits(found, capsys) < 2000
    assert found.count() == 5 * 12


def test_opened_nodes_carry_no_links():
    state = {"q": 1, "asked": [1.0, 0.0], "node": [], "s": [], "opened": [], "links": [], "seen": [1, 2], "next": [1, 2]}
    kinds = {"q": pa.int64(), "asked": pa.list_(pa.float64()), "node": pa.list_(pa.int64()), "s": pa.list_(pa.float64()), "opened": pa.list_(pa.bool_())}
    kinds |= {"links": pa.list_(pa.list_(pa.int64())), "seen": pa.list_(pa.int64()), "next": pa.list_(pa.int64())}
    many = [*range(1, 200)]
    met = {"node": many, "vector": [[1.0, 0.01 * i] for i in many], "links": [[i + 1, 1000 + i] for i in many]}
    after = ann._step(pa.table(met), pa.table({n: pa.array([state[n]], t) for n, t in kinds.items()})).to_pylist()[0]
    assert sum(after["opened"]) == ann.OPENED
    assert all((x == []) == o for x, o in zip(after["links"], after["opened"]))
    assert set(after["next"]) == ({i + 1 for i in many[: ann.OPENED]} | {1000 + i for i in many[: ann.OPENED]}) - {1, 2}


def test_shuffle_files_of_rounds_go_at_once_and_the_setting_stays(spark):
    before = spark.conf.get(scratch.CLEANUP, None)
    with scratch.shuffles_freed(spark):
        assert spark.conf.get(scratch.CLEANUP) == "true"
        kept = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().checkpoint()
    assert spark.conf.get(scratch.CLEANUP, None) == before
    assert sorted(kept.collect()) == [(k, 1000 // 7 + (k < 1000 % 7)) for k in range(7)]

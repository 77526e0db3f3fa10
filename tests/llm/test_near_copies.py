"""Nearest neighbours among near copies and vectors of extreme size, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from incident_engine.llm import ann, queries


def recall(spark, x, every):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(queries.prepared(spark, df.repartition(4)), F.col("id") % every == 0).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    hits = 0
    for i in range(0, len(x), every):
        s = unit @ unit[i]
        s[i] = -9
        hits += len(set(np.argsort(-s)[:5].tolist()) & set(got[i]))
    return hits / (5 * len(range(0, len(x), every)))


@pytest.mark.parametrize("noise", [2e-4, 1e-6])
def test_near_copies_are_told_apart(spark, noise):
    rng = np.random.default_rng(3)
    base = rng.standard_normal(32)
    x = np.concatenate([rng.standard_normal((300, 32)), base + noise * rng.standard_normal((900, 32))])
    assert recall(spark, rng.permutation(x), 30) >= 0.9


def test_vectors_of_extreme_size(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((60, 8)) * 10.0 ** rng.choice([-200, -1, 0, 200], (60, 1))
    assert recall(spark, x, 5) == 1.0


def test_scaling_changes_no_score():
    rng = np.random.default_rng(5)
    x, q = rng.standard_normal((50, 16)), rng.standard_normal(16)
    dot = lambda a, b: np.einsum("ij,ij->i", a, b)
    many = np.tile(q, (50, 1))
    assert (ann._scores(q, x) == dot(many, x) / (np.sqrt(dot(many, many)) * np.sqrt(dot(x, x)))).all()

"""The toxicity model depends on its rows, not on how they are spread."""

import random

import numpy as np
import pyarrow as pa

from incident_engine.llm import queries, toxicity


def test_least_hashes_do_not_depend_on_the_order():
    rnd = random.Random(1)
    swaps = [((rnd.randrange(9),), (rnd.randrange(9), 9)) for _ in range(300)]
    first = toxicity.least_hashes(swaps, 50)
    for _ in range(3):
        rnd.shuffle(swaps)
        assert toxicity.least_hashes(swaps, 50) == first
    assert sorted(toxicity.least_hashes(swaps, 1000)) == sorted(swaps) and toxicity.least_hashes([], 5) == []


def test_model_is_the_same_on_any_layout(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SWAPS", 40)  # fewer than there are
    rnd = random.Random(2)
    rows = []
    for i in range(300):
        bad = i % 3 == 0
        said = rnd.choice(["hateful trash", "vile scum"]) if bad else rnd.choice(["kind people", "good friends"])
        rows.append((f"The {rnd.choice(['women', 'men', 'muslims', 'jews'])} are {said} of town {rnd.randrange(40)}.", int(bad)))
    models = []
    for parts in (1, 7):
        df = queries.prepared(spark, spark.createDataFrame(rows, "text string, toxic long").repartition(parts))
        models.append(toxicity.fit(df))
    assert (models[0].keys == models[1].keys).all() and models[0].constant == models[1].constant
    assert np.array_equal(models[0].weights, models[1].weights)
    bad, good = models[0].scores(pa.array(["The men are vile scum.", "The muslims are kind people."]))
    assert bad > 0.5 > good

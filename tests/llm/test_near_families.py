"""Families of near copies: typical centres, blocks of parts, and components against brute force."""

import random

from incident_engine.llm import near_dup, queries


def variant(rnd, base, edits):
    words = base.copy()
    for k in rnd.sample(range(len(words)), edits):
        words[k] = f"e{rnd.randint(0, 10**7)}"
    return words


def plain_components(words, percent):
    """The smallest id reachable from each, by comparing all pairs."""
    sets = {d: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for d, w in words.items()}
    least = {d: d for d in sets}

    def top(d):
        while least[d] != d:
            d = least[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                least[max(x, y)] = min(x, y)
    return {d: top(d) for d in sets}


def found(spark, words, percent):
    rows = [(d, " ".join(w)) for d, w in words.items()]
    df = queries.prepared(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    return {r.id: r.component for r in near_dup.near_duplicates(df, percent=percent).collect()}


def test_a_family_is_settled_by_its_centre(spark, monkeypatch):
    rnd = random.Random(3)
    base = [f"b{rnd.randint(0, 10**6)}" for _ in range(300)]
    words = {i: variant(rnd, base, 4) for i in range(250)} | {900: base}  # copies are linked through the last row only
    monkeypatch.setattr(near_dup, "_left_links", None)  # not needed
    got = found(spark, words, 85)
    assert got == plain_components(words, 85) and set(got.values()) == {0}


def test_parts_and_singles_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rnd = random.Random(9)
    words = {}
    for f in range(3):
        base = [f"f{f}w{rnd.randint(0, 10**6)}" for _ in range(150)]
        for i in range(70):
            words[len(words) * 3 % 1009] = variant(rnd, base, rnd.choice([1, 2, 3, 5, 6, 7]))
    for percent in (80, 85):
        want = plain_components(words, percent)
        assert len(set(want.values())) > 20 and found(spark, words, percent) == want


def test_blocks_of_one_part_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rows = [(1, n, 0) for n in range(50)] + [(k, n, n) for n in range(60, 75) for k in (1, 2)]
    left = queries.prepared(spark, spark.createDataFrame(rows, "key long, node long, part long"))
    placed = near_dup._blocks(left).checkpoint()
    of = {r.node: (r.part, r.block) for r in placed.collect()}
    assert len(of) == 65 and all((b.own, b.of) == ((True, 0) if p == 0 else (False, 0)) for p, b in of.values())
    pairs = {(r.low, r.high) for r in near_dup._meetings(left, placed).collect()}
    assert not any(a.own and b.own for a, b in pairs)
    blocks = {b for _, b in of.values()}
    assert len({b for b in blocks if b.own}) >= 5
    assert all((min(a, b), max(a, b)) in pairs for a in blocks for b in blocks if not (a.own and b.own))


def test_typical_pairs_leave_out_spent_centres_and_settled_parts(spark):
    rows = [(1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 2, 2), (2, 3, 3), (3, 3, 3), (3, 4, 4), (4, 8, 8), (4, 9, 8)]
    left = spark.createDataFrame(rows, "key long, node long, part long")
    pairs = lambda spent: sorted((r.a, r.b) for r in near_dup._typical_pairs(left, spent).collect())
    assert pairs(None) == [(3, 1), (3, 2), (3, 4)]
    assert pairs(spark.createDataFrame([(3,)], "node long")) == [(2, 1), (2, 3)]

"""Periodic runs against a plain search over all periods, with odd rows."""

import random
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest

import __spark_entry__ as contract
from incident_engine.llm import periodic_runs, queries

BLANKS = " \t\n\x0b\x0c\r"


def split(text):
    for b in BLANKS:
        text = text.replace(b, " ")
    return [w for w in text.split(" ") if w]


def plain_runs(words):
    """start, length, period of every run: each period's maximal stretches, without those of a smaller period."""
    number = {w: k for k, w in enumerate(sorted(set(words)))}
    ids, found = np.array([number[w] for w in words], np.int64), {}
    for q in range(1, len(ids) // 3 + 1):
        edges = np.diff(np.concatenate([[0], ids[:-q] == ids[q:], [0]]).astype(np.int8))
        for i, j in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)  # a stretch of a multiple of its period is the same stretch
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def by_start_and_period(runs):
    return sorted(runs, key=lambda r: (r[0], r[2]))


def tiled_runs(words):
    """What the tiles of one document give, stitched here in the order of their starts."""
    ids = periodic_runs.numbered([w.encode() for w in words])
    got = set()
    for k, low, marks, raw in periodic_runs.tiles(ids):
        part = ids[low : low + len(raw) // 4].tolist()
        got |= set(periodic_runs.fragments(k, low, marks, part))
    runs = []
    for q, start, stop in sorted(got):
        if runs and runs[-1][0] == q and start <= runs[-1][2] - q:
            runs[-1][2] = max(runs[-1][2], stop)
        else:
            runs.append([q, start, stop])
    return sorted((s, e - s, q) for q, s, e in runs)


def periodic(rnd, alphabet, period, n):
    unit = [rnd.choice(alphabet) for _ in range(period)]
    return (unit * (n // period + 1))[:n]


def odd_texts():
    rnd = random.Random(11)
    many, two = [f"w{i}" for i in range(400)], ["a", "b"]
    say = lambda n, alphabet=many: [rnd.choice(alphabet) for _ in range(n)]
    fib = ["a", "ab"]
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + fib[-2])
    thue = [0]
    while len(thue) < 1024:
        thue += [1 - x for x in thue]
    out = [[], ["one"], ["x"] * 23, ["x"] * 24, ["x"] * 25, ["x"] * 5000, two * 12, (two * 12)[:-1], say(300), list(fib[-1]), [str(x) for x in thue]]
    for p in (1, 2, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 100, 257, 700):
        length = max(24, 3 * p)
        out.append(say(rnd.randint(0, 90)) + periodic(rnd, many, p, length) + say(40))
        out.append(periodic(rnd, many, p, length - 1))
        out.append(say(rnd.randint(0, 40)) + periodic(rnd, many, p, 7 * p + 30) + periodic(rnd, many, p, 4 * p + 24))
    one = periodic(rnd, many, 10, 200)
    out += [one + one, one + one[3:], one[:-1] + ["z"] + one, periodic(rnd, many, 600, 12_000), say(20_000), say(3000, two), say(2000, ["a", "b", "c"])]
    nested = periodic(rnd, two, 3, 30)
    out += [(nested + ["n"]) * 6, ((["a"] * 30 + ["b"] * 30) * 5), say(50) + (nested + say(20)) * 4]
    return out


@pytest.mark.parametrize("k", range(0, 68, 4))
def test_tiles_find_the_runs_of_a_plain_search(k):
    for words in odd_texts()[k : k + 4]:
        assert tiled_runs(words) == plain_runs(words)


def test_random_texts_of_few_words():
    rnd = random.Random(3)
    for _ in range(300):
        words = []
        while len(words) < rnd.randint(0, 300):
            unit = [rnd.choice("ab") for _ in range(rnd.randint(1, 40))]
            words += unit * rnd.randint(1, 9)
            if words and rnd.random() < 0.5:
                words[rnd.randrange(len(words))] = "c"
        assert tiled_runs(words) == plain_runs(words)


def test_runs_across_many_tiles(monkeypatch):
    monkeypatch.setattr(periodic_runs, "TILE_WORDS", 16)
    monkeypatch.setattr(periodic_runs, "PAIRS", 64)
    rnd = random.Random(4)
    words = ["p"] * 50 + periodic(rnd, [f"w{i}" for i in range(99)], 12, 4000) + ["q"] * 3000
    assert len(list(periodic_runs.tiles(periodic_runs.numbered([w.encode() for w in words])))) > 20
    assert tiled_runs(words) == plain_runs(words)


def test_z_function_and_powers():
    rnd = random.Random(6)
    for _ in range(200):
        s = [rnd.randrange(2) for _ in range(rnd.randint(0, 30))]
        want = [next((m for m in range(len(s) - i) if s[m] != s[i + m]), len(s) - i) for i in range(len(s))]
        assert periodic_runs.z_function(s) == want
        for q in range(1, len(s) + 1):
            power = any(q % p == 0 and s[:q] == s[:p] * (q // p) for p in range(1, q))
            assert periodic_runs.is_power(q, want) == power


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(8)
    texts = [rnd.choice(BLANKS).join(w) + rnd.choice(["", "\n"]) for w in odd_texts()] + [None, None, "é日 " * 40, "    " * 30, "x" * 300_000]
    rows = [(i, t, "r", 1, "c") for i, t in enumerate(texts)] + [(5, texts[5], "r", 1, "c"), (None, texts[12], "r", 1, "c"), (None, None, "r", 1, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, row long, collapsed string")
    return queries.prepared(spark, df.repartition(5))


def test_operator_equals_a_plain_search(docs):
    found = periodic_runs.collapse_runs(docs)
    assert found.columns == [*docs.columns, "runs_", "collapsed_"]
    rows = found.collect()
    assert sorted(map(repr, docs.collect())) == sorted(repr(r) for r in found.select(docs.columns).collect())
    for r in rows:
        words = split(r.text or "")
        runs = plain_runs(words)
        assert [(x.start, x.length, x.period) for x in r.runs_] == by_start_and_period(runs)
        assert r.collapsed_ == collapsed(words, runs)
        assert (r.runs, r.row, r.collapsed) == ("r", 1, "c")


def test_digests_and_an_empty_table(docs):
    found = periodic_runs.collapse_runs(docs, as_digest=True)
    assert found.columns == ["doc_id", "runs", "row", "collapsed", "runs_", "collapsed_"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in found.where("doc_id IS NOT NULL").collect():
        words = split(texts[r.doc_id] or "")
        assert r.collapsed_ == sha256(collapsed(words, plain_runs(words)).encode()).hexdigest()
    assert periodic_runs.collapse_runs(docs.where("false")).count() == 0


def test_query_equals_a_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in contract.queries()["op13_scale_tiles"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    with_runs = 0
    for doc_id, text in rows:
        words = split(text or "")
        n = len(words)
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = by_start_and_period(plain_runs(words))
        with_runs += bool(runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        r = got[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *(best or (None,) * 3))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == sha256(collapsed(words, runs).encode()).hexdigest()
    assert with_runs >= 10
